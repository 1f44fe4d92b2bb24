from datetime import date, datetime

import pytest

from daybook.plans import archiving, flows
from daybook.plans.jobs import NO_ROWS, Workspace
from daybook.plans.labels import Labels
from daybook.plans.locality import ward_schema
from daybook.plans.reports import METRICS
from daybook.plans.run import Run
from daybook.plans.tables import ingest_into, table_schema
from daybook.session import work_folder
from daybook.sources.archives import read_manifest
from daybook.sources.collections import SCHEMAS
from daybook.sources.keyed import current

LABELS = Labels("Acme", "Pen")
MADE = datetime(2025, 5, 1)
RUN, NEXT = Run.on("2025-05-15"), Run.on("2025-06-02")


def credential(key, status="0", locality="HN", name="An", subject=None, contract=True, certs=True):
    return {
        "_id": key,
        "identity": {"name": name, "LocalityCode": locality, "username": "OPERx", "source": "4"},
        "contract": {"servicePack": "Pen Personal App Sign Limit Std", "pricingCode": " "} if contract else None,
        "subjectDN": subject,
        "status": status,
        "createdDate": MADE,
        "certs": [
            {"status": "1", "statusDesc": "old", "validFrom": MADE, "validTo": MADE, "requestId": "r0", "serial": "s0"},
            {
                "status": "1",
                "statusDesc": "on",
                "validFrom": MADE,
                "validTo": datetime(2026, 5, 1),
                "requestId": "r1",
                "serial": "s1",
            },
        ]
        if certs
        else [],
    }


class Documents:
    """Collections held in memory; the second run sees changed ones."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {
            "Register": [
                {"_id": "u1", "status": 3, "createdDate": MADE, "fullName": "Binh", "address": {"provinceId": "7"}},
                {"_id": "u2", "status": 3, "createdDate": MADE, "fullName": "Chi"},
            ],
            "User": [{"_id": "u1", "createDate": MADE, "roles": [{"name": "a"}, None, {"name": None}]}],
            "CertOrder": [
                {
                    "_id": "o1",
                    "FullName": "Binh",
                    "Pricing": {"PricingName": "p"},
                    "DHSXKDCustomerInfo": {"ma_gd": "g"},
                    "Status": 52,
                    "IdentityId": "u1",
                    "CreatedDate": MADE,
                },
                {"_id": "no pricing", "DHSXKDCustomerInfo": {"ma_gd": "g"}, "CreatedDate": MADE},
                {"_id": "no date", "Pricing": {"PricingName": "p"}, "DHSXKDCustomerInfo": {"ma_gd": "g"}},
            ],
            "PersonalSignTurnOrder": [{"_id": "t1", "CreatedDate": MADE}],
            "Credential": [
                credential("c1"),
                credential("c2", locality=" "),
                credential("tester", name="a test"),
                credential("subject", subject="CN=A Test,O=X"),
                credential("broken", contract=False),
                credential("bare", certs=False),
            ],
            "RequestCert": [
                {
                    "_id": "r1",
                    "status": "5",
                    "requestType": "0",
                    "pricingCode": "17187",
                    "credentialId": "c1",
                    "createdDate": MADE,
                    "username": " ",
                }
            ],
            "Cert": [{"requestId": "r9", "validFrom": MADE, "validTo": MADE, "createDate": MADE, "serial": "s"}],
            "SignatureTransaction": [
                {"_id": f"x{i}", "reqTime": datetime(2025, 4, 20 + i), "status": "1", "appId": "app", "appName": "App"}
                for i in range(3)
            ],
            "CutOff": [
                {
                    "sourceCollection": "SignatureTransaction",
                    "collectionName": f"Archive{year}",
                    "fromTime": datetime(year, 1, 1),
                    "toTime": datetime(year, 12, 31),
                }
                for year in (2023, 2024)
            ],
            "Archive2024": [
                {"_id": "a1", "reqTime": datetime(2024, 11, 1), "appId": "old"},
                {"_id": "a2", "reqTime": datetime(2024, 1, 1), "appId": "before the window"},
            ],
            "ProblemGuide": [{"_id": "p1", "Status": "1", "type": "t"}],
            "AreaLocal": [{"code": "01", "name": "north", "localities": [{"code": "HN", "name": "Hanoi"}]}],
            "Wards": [{"ProvinceId": 7, "ProvinceCode": "HN", "WardId": 1, LABELS.ward_field: 4}],
        }

    def __call__(self, collection):
        ddl = ward_schema(LABELS) if collection == "Wards" else SCHEMAS[collection]
        return self.spark.createDataFrame(self.rows[collection], ddl)

    def archives(self, names):
        assert names == ["Archive2024"], "2023 does not meet the window"
        return self.spark.createDataFrame(self.rows[names[0]], SCHEMAS["SignatureTransaction"])


@pytest.fixture(scope="module")
def space(spark):
    root = work_folder(spark, "jobs")
    dictionary = f"{root}/dictionary"
    entries = [("status", "CertOrder", 52, "failed"), ("status", "Register", 3, "done")]
    spark.createDataFrame(entries, "type string, table string, code int, description_vi string").write.parquet(dictionary)
    documents = Documents(spark)
    return Workspace(spark, root, documents, documents.archives, LABELS, dictionary, 4)


def test_daily_ingest_reports_and_cut_off(spark, space):
    assert space.report_signing(NEXT) == NO_ROWS

    outcome = space.ingest(RUN)
    assert {c: o["quarantined"] for c, o in outcome.items() if o["quarantined"]} == {"Credential": 1}
    assert {c: o["scanned"] for c, o in outcome.items()} == {
        "Register": 2, "User": 1, "CertOrder": 2, "PersonalSignTurnOrder": 1, "Credential": 6, "RequestCert": 1,
        "Cert": 1, "SignatureTransaction": 4,
    }
    assert set(outcome) == {f.collection for f in flows.DAILY}

    users = {r.row_key: r for r in space.table("User").collect()}
    assert (users["u1"].info.roles, users["u1"].register.full_name) == ("a, ", "Binh")
    assert users["u2"].info is None

    credentials = {r.row_key: r for r in space.table("Credential").collect()}
    assert set(credentials) == {"c1", "c2", "bare"}
    assert credentials["c1"].info.pricing_code == "17187"
    assert credentials["c1"].info.serial == "s1"
    assert credentials["c1"].status_log == {date(2025, 5, 14): "0"}
    assert (credentials["c1"].info.locality_code, credentials["c2"].info.locality_code) == ("HN", "OPE")
    assert (credentials["bare"].info.cert_status, credentials["bare"].info.valid_to) == ("", None)
    assert {r.row_key for r in space.table("Cert").collect()} == {"r1", "r9"}
    assert [r.info.sign_turn_number for r in space.table("PersonalSignTurnOrder").collect()] == ["0"]

    assert all("scanned" not in o for o in space.ingest(RUN).values()), "a finished run is not repeated"

    # A second run changes one status, which is logged, and leaves the rest alone.
    space.documents.rows["Credential"][0] = credential("c1", status="1")
    space.ingest(NEXT)
    again = {r.row_key: r for r in space.table("Credential").collect()}
    assert again["c1"].status_log == {date(2025, 5, 14): "0", date(2025, 6, 1): "1"}
    assert again["c2"] == credentials["c2"]

    assert space.report_signing(Run.on("2025-05-15")) == ""
    signing = spark.read.parquet(f"{space.root}/signature_by_client").collect()
    assert [(r.client_name, r.success, r.report_year) for r in signing] == [("App", 3, 2025)]

    assert space.report_cumulative(NEXT) == ""
    cumulative = {
        r.locality_code: {m: r[m] for m in METRICS if r[m]}
        for r in spark.read.parquet(f"{space.root}/accumulate_credential").collect()
    }
    # c1 is no longer active, so its certificate request counts for nothing.
    assert cumulative == {
        "HN": {"total_vneid": 1},
        "OPE": {"total_vneid": 1},
        "": {},
    }

    assert space.cut_off("Locality", NEXT)
    assert space.report_order_state(NEXT) == ""
    state = spark.read.parquet(f"{space.root}/cert_order_register").collect()
    assert {(r.ten_kh, r.ma_tinh, r.ly_do_gd) for r in state} == {("Binh", "", "failed"), ("Chi", "", "done")}

    assert space.cut_off("SignatureTransaction", NEXT)
    assert space.table("SignatureTransaction").count() == 0
    entry = read_manifest(spark, f"{space.root}/manifest").filter("table_name = 'SignatureTransaction'").first()
    assert entry["count"] == 4
    assert entry.file_name.endswith("signature_transaction_20241101000000_20250422000000.parquet")
    assert (entry.start_time, entry.end_time) == ("2024-11-01 00:00:00.000000", "2025-04-22 00:00:00.000000")
    archive = spark.read.parquet(entry.file_name)
    assert archive.columns[:2] == ["_id", "date_report"] and archive.count() == 4
    assert not space.cut_off("SignatureTransaction", NEXT), "nothing left to archive"

    assert space.cut_off("ProblemGuide", NEXT)
    guide = space.table("ProblemGuide").first()
    assert (guide.info.type_error, guide.info.created_date) == ("t", datetime(2025, 6, 2))
    assert space.cut_off("User", NEXT) and not space.cut_off("Unknown", NEXT)


def test_archiving_can_be_started_again(spark, monkeypatch):
    root = work_folder(spark, "again")
    rows = [{"_id": f"x{i}", "reqTime": datetime(2025, 4, 20 + i)} for i in range(3)]
    documents = spark.createDataFrame(rows, SCHEMAS["SignatureTransaction"])
    ingest_into(spark, root, flows.SIGNATURE_TRANSACTION, documents, RUN, "1", LABELS, buckets=4)

    def live():
        return current(spark, root, "SignatureTransaction", table_schema(spark, "SignatureTransaction")).count()

    def fail(*_, **__):
        raise RuntimeError("lost")

    for step in ("append_manifest", "publish_empty"):
        with monkeypatch.context() as patched:
            patched.setattr(archiving, step, fail)
            with pytest.raises(RuntimeError):
                archiving.archive_transactions(spark, root, NEXT)
        assert live() == 3, "nothing is emptied before the archive is recorded"
    assert archiving.archive_transactions(spark, root, NEXT)
    assert live() == 0
    assert read_manifest(spark, f"{root}/manifest").count() == 1

    # The same rows once more, under another run: the recorded archive is not overwritten.
    ingest_into(spark, root, flows.SIGNATURE_TRANSACTION, documents, RUN, "3", LABELS, buckets=4)
    with pytest.raises(FileExistsError):
        archiving.archive_transactions(spark, root, Run.on("2025-07-01"))
    assert live() == 3


@pytest.mark.parametrize("change", ["case when _id = 'x1' then 'other' else status end as status", "app_id as app_name, app_name as app_id"])
def test_an_archive_with_another_cell_does_not_empty_the_table(spark, monkeypatch, change):
    root = work_folder(spark, "cell")
    rows = [{"_id": f"x{i}", "reqTime": datetime(2025, 4, 20 + i), "status": "1", "appId": "a"} for i in range(3)]
    documents = spark.createDataFrame(rows, SCHEMAS["SignatureTransaction"])
    ingest_into(spark, root, flows.SIGNATURE_TRANSACTION, documents, RUN, "1", LABELS, buckets=4)
    schema = table_schema(spark, "SignatureTransaction")
    with monkeypatch.context() as patched:
        patched.setattr(archiving, "publish_empty", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            archiving.archive_transactions(spark, root, NEXT)
    path = read_manifest(spark, f"{root}/manifest").first()["file_name"]
    kept = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    changed = [c.split(" as ")[-1] for c in change.split(", ")]
    kept.selectExpr(*[c for c in kept.columns if c not in changed], *change.split(", ")).select(kept.columns).write.mode("overwrite").parquet(path)
    with pytest.raises(RuntimeError, match="no copy"):
        archiving.archive_transactions(spark, root, NEXT)
    assert current(spark, root, "SignatureTransaction", schema).count() == 3
    kept.write.mode("overwrite").parquet(path)
    assert archiving.archive_transactions(spark, root, NEXT)


def test_every_flow_column_is_declared_once(spark):
    for flow in (*flows.DAILY, flows.PROBLEM_GUIDE):
        cells = {f: flow.cells(f) for f in flow.families}
        first = next(iter(cells.values()))
        assert set(flow.patch.split()) <= set(first)
        assert set(flow.fill.split()) <= set(flow.patch.split())
        schema = table_schema(spark, flow.table)
        for family, columns in cells.items():
            assert schema[family].dataType.names == list(columns)
    sizes = [len(f.cells(next(iter(f.families)))) for f in (*flows.DAILY, flows.PROBLEM_GUIDE)]
    assert sizes == [14, 29, 36, 24, 27, 19, 7, 17, 8]
