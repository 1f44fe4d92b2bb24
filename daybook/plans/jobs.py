"""The jobs a scheduler starts: daily ingest, three reports and the cut-off.

Below ``root`` lie the versions of the keyed tables (``<table>/``), their list
(``versions``), the reports, the archives and snapshots, and their ``manifest``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from daybook.plans import flows
from daybook.plans.archiving import ACCEPTED, ARCHIVED, archive_transactions
from daybook.plans.labels import Labels
from daybook.plans.locality import publish_localities, read_localities
from daybook.plans.reports import cumulative_report, order_state_report, signing_report
from daybook.plans.run import Run
from daybook.plans.tables import daily_ingest, ingest_into, table_schema
from daybook.session import configure
from daybook.sources.keyed import current
from daybook.sources.parquet import read_dictionary, write_report

# Report folders, and the answer of a report without rows.
SIGNING_FOLDER = "signature_by_client"
CUMULATIVE_FOLDER = "accumulate_credential"
ORDER_STATE_FOLDER = "cert_order_register"
NO_ROWS = "Không có bản ghi phù hợp"


@dataclass(frozen=True)
class Workspace:
    """Where the jobs read and write.

    ``documents`` opens a collection by name, ``open_archives`` archived transaction
    collections, all that are named at once.
    """

    spark: SparkSession
    root: str
    documents: Callable[[str], DataFrame]
    open_archives: Callable[[list[str]], DataFrame]
    labels: Labels
    dictionary: str = ""
    buckets: int = 200

    def __post_init__(self) -> None:
        configure(self.spark)

    def table(self, name: str) -> DataFrame:
        return current(self.spark, self.root, name, table_schema(self.spark, name))

    def _report(self, report: DataFrame, folder: str, stamp: str, year: int) -> str:
        """A report is filed under the year of the period it closes, not of the day it runs."""
        rows = write_report(report, f"{self.root}/{folder}", stamp, year)
        return "" if rows else NO_ROWS

    def ingest(self, run: Run) -> dict[str, dict[str, object]]:
        return daily_ingest(
            self.spark, self.root, self.documents, run, self.labels, self.open_archives, self.buckets
        )

    def report_signing(self, run: Run) -> str:
        """Empty text on success, like the other reports."""
        return self._report(signing_report(self.table(ARCHIVED), run), SIGNING_FOLDER, "data_report", run.closed_month_end.year)

    def report_cumulative(self, run: Run) -> str:
        report = cumulative_report(self.table("Credential"), self.table("Cert"), run)
        return self._report(report, CUMULATIVE_FOLDER, "date_report", run.closed_day.year)

    def report_order_state(self, run: Run) -> str:
        report = order_state_report(
            self.table("CertOrder"),
            self.table("User"),
            read_dictionary(self.spark, self.dictionary),
            read_localities(self.spark, self.root, self.labels),
            run,
        )
        return self._report(report, ORDER_STATE_FOLDER, "ngay_lay_dl", run.closed_day.year)

    def cut_off(self, table: str, run: Run) -> bool:
        """Archive or snapshot a table. Other known tables are accepted, unknown ones refused."""
        if table == ARCHIVED:
            return archive_transactions(self.spark, self.root, run)
        if table == "Locality":
            wards, areas = self.documents("Wards"), self.documents("AreaLocal")
            publish_localities(self.spark, self.root, wards, areas, run, self.labels)
            return True
        if table == "ProblemGuide":
            flow, stamp = flows.PROBLEM_GUIDE, f"{run.time:%Y%m%d%H%M%S}"
            ingest_into(
                self.spark, self.root, flow, self.documents(table), run, stamp, self.labels, self.buckets
            )
            return True
        return table in ACCEPTED
