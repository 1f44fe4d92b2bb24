"""Ingest flows: document collections to keyed tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daybook.functions.cells import cell, struct_of
from daybook.functions.records import (
    EXPIRED_DESC,
    EXPIRED_STATUS,
    default_pricing,
    expire,
    failure_log,
    last_item,
)
from daybook.functions.text import (
    is_space,
    joined_names,
    locality_from_username,
    mentions_test,
    subject_mentions_test,
)
from daybook.functions.times import month_label, real_instant_or
from daybook.operators.merge import KEY, PERIOD, insert_or_patch, latest_per_key, put_columns, replace_rows
from daybook.plans.labels import Labels
from daybook.plans.run import Run
from daybook.sources.collections import WINDOW_FIELDS, in_window


def always(_: Labels) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Flow:
    """One collection's way into a keyed table.

    ``families`` maps a column family to lines of ``column source [cell]``. The
    first family decides between insert and patch; its ``born`` column tells the
    month a new row is stored under. ``keep`` drops records on purpose; kept
    records that miss something ``required`` are quarantined.
    """

    collection: str
    table: str
    families: dict[str, str]
    born: str
    key: str = "_id"
    write: str = "patch"
    patch: str = ""
    fill: str = ""
    newest: str = ""
    keep: Callable[[Labels], Column] = always
    required: Callable[[], Column] = lambda: F.lit(True)
    derive: Callable[[Run, Labels], dict[str, Column]] = field(default=lambda run, labels: {})
    history: tuple[str, str] | None = None

    def cells(self, family: str) -> dict[str, str]:
        lines = (line.split() for line in self.families[family].strip().splitlines())
        return {name: cell(source, *kind) for name, source, *kind in lines}

    def _complete(self) -> Column:
        return F.coalesce(F.col(self.key).isNotNull() & self.required(), F.lit(False))

    def scan(
        self, documents: DataFrame, run: Run, labels: Labels, seen: Observation | None = None
    ) -> DataFrame:
        """Documents of the run's window; problem guides are always read in full.

        ``seen`` is filled, by whatever writes the result, with the number of records
        scanned and quarantined; no second scan counts them.
        """
        if self.collection in WINDOW_FIELDS:
            documents = in_window(documents, self.collection, *run.ingest_window)
        if seen is None:
            return documents
        return documents.observe(
            seen,
            F.count("*").alias("scanned"),
            F.count_if(self.keep(labels) & ~self._complete()).alias("quarantined"),
        )

    def quarantined(self, documents: DataFrame, run: Run, labels: Labels) -> DataFrame:
        """Records of the window that should be kept but cannot be written, whole, for inspection."""
        return self.scan(documents, run, labels).filter(self.keep(labels)).filter(~self._complete())

    def flatten(self, documents: DataFrame, run: Run, labels: Labels) -> DataFrame:
        """Keyed rows of the usable documents, one per key."""
        usable = documents.filter(self.keep(labels)).filter(self._complete())
        extra = self.derive(run, labels)
        derived = usable.withColumns(extra) if extra else usable
        first = next(iter(self.families))
        newest = [f"_newest_{c}" for c in self.newest.split()]
        rows = derived.selectExpr(
            f"cast({self.key} as string) as {KEY}",
            *[f"{struct_of(self.cells(f))} as {f}" for f in self.families],
        ).selectExpr("*", *[f"{first}.{c} as _newest_{c}" for c in self.newest.split()])
        period = F.coalesce(month_label(F.col(f"{first}.{self.born}")), F.lit("none"))
        return latest_per_key(rows, newest).select(KEY, *self.families, period.alias(PERIOD))

    def merge(self, target: DataFrame, rows: DataFrame, run: Run) -> DataFrame:
        family, *companions = self.families
        if self.write == "replace":
            return replace_rows(target, rows)
        if self.write == "put":
            return put_columns(target, rows, family)
        history = (*self.history, run.closed_day.isoformat()) if self.history else None
        return insert_or_patch(target, rows, family, self.patch.split(), self._filled(family), companions, history)

    def _filled(self, family: str) -> list[str]:
        """Patch columns that are filled when absent: texts, whose blank is another value, and those named."""
        lines = (line.split() for line in self.families[family].strip().splitlines())
        dated = {name for name, _, *kind in lines if kind and kind[0] in ("instant", "as_is")}
        return [c for c in self.patch.split() if c not in dated or c in self.fill.split()]

    def ingest(self, target: DataFrame, documents: DataFrame, run: Run, labels: Labels) -> DataFrame:
        """Windowed scan, flatten and merge."""
        return self.merge(target, self.flatten(self.scan(documents, run, labels), run, labels), run)


# Fixed values, all of the column maps below: names of the keyed columns and the
# document fields they come from, in table order.

CERT_ORDER = Flow(
    collection="CertOrder",
    table="CertOrder",
    families={
        "info": """
            identity_id IdentityId
            uid Uid
            full_name FullName
            email Email
            phone Phone
            locality_code LocalityCode
            type Type
            type_desc TypeDesc
            status Status
            status_desc StatusDesc
            client_name ClientName
            client_id ClientId
            created_date CreatedDate as_is
            updated_date UpdatedDate instant
            ma_tb DHSXKDCustomerInfo.ma_tb
            ma_gd DHSXKDCustomerInfo.ma_gd
            ma_kh DHSXKDCustomerInfo.ma_kh
            ma_hd DHSXKDCustomerInfo.ma_hd
            ma_hrm DHSXKDCustomerInfo.ma_hrm
            address Address.address
            source Source
            request_cert_id RequestCertId
            serial Serial
            credential_id CredentialId
            pricing_code Pricing.PricingCode
            pricing_name Pricing.PricingName
            pricing_price Pricing.Price
            code Pricing.Code
            sign_type Pricing.SignType
            validity Pricing.Validity
            ma_gt MaGt
            previous_serial PreviousSerial
            contract_url ContractUrl
            acceptance_url _acceptance.UrlSigned
            log_content _log.Content as_is
            log_created_date _log.CreatedDate as_is
        """,
        "address": """
            province_id Address.provinceId
            province_name Address.provinceName
            district_id Address.districtId
            district_name Address.districtName
            ward_id Address.wardId
            ward_name Address.wardName
            street_name Address.streetName
            address_detail Address.address
        """,
    },
    patch="status status_desc updated_date request_cert_id credential_id contract_url"
    " acceptance_url log_content log_created_date serial",
    fill="log_content log_created_date",
    newest="updated_date created_date",
    born="created_date",
    keep=lambda labels: (
        F.col("Pricing").isNotNull()
        & F.col("DHSXKDCustomerInfo").isNotNull()
        & ~mentions_test(F.col("FullName"))
        & ~mentions_test(F.col("Pricing.PricingName"))
        & ~mentions_test(F.col("DHSXKDCustomerInfo.ma_gd"))
    ),
    required=lambda: F.col("CreatedDate").isNotNull(),
    derive=lambda run, labels: {
        "_log": failure_log(F.col("Status"), F.col("UpdatedDate"), F.col("Logs")),
        "_acceptance": last_item(F.col("AcceptanceDocuments")),
    },
)

REGISTER = Flow(
    collection="Register",
    table="User",
    families={
        "register": """
            full_name fullName
            uid uid
            phone phone
            email email
            status status
            status_desc statusDesc
            create_date createdDate instant
            modified_date modifiedDate instant
            source source
            province_id address.provinceId
            district_id address.districtId
            ward_id address.wardId
            street_name address.streetName
            address address.address
        """,
    },
    patch="status status_desc modified_date",
    newest="modified_date create_date",
    born="create_date",
)

USER = Flow(
    collection="User",
    table="User",
    families={
        "info": """
            uid uid
            username username
            full_name fullName
            phone phone
            email email
            locality_code localityId
            uid_prefix uidPrefix
            user_group_id userGroupId
            status status
            status_desc statusDesc
            create_date createDate as_is
            modified_date modifiedDate instant
            account_type accountType
            account_type_desc accountTypeDesc
            is_com_admin isComAdmin flag
            is_test isTest flag
            pre_status preStatus
            province_code provinceCode
            province_codes _province_codes blank
            source source
            province_id identityAddress.provinceId
            province_name identityAddress.provinceName
            district_id identityAddress.districtId
            district_name identityAddress.districtName
            ward_id identityAddress.wardId
            ward_name identityAddress.wardName
            street_name identityAddress.streetName
            address identityAddress.address
            roles _roles blank
        """,
    },
    patch="status status_desc modified_date province_code province_codes roles pre_status",
    newest="modified_date create_date",
    born="create_date",
    required=lambda: F.col("createDate").isNotNull(),
    derive=lambda run, labels: {
        "_province_codes": joined_names(F.col("provinceCodes")),
        "_roles": joined_names(F.col("roles")),
    },
)

PERSONAL_SIGN_TURN_ORDER = Flow(
    collection="PersonalSignTurnOrder",
    table="PersonalSignTurnOrder",
    families={
        "info": """
            identity_id UserInfo._id
            uid UserInfo.Uid
            full_name UserInfo.FullName
            locality_code UserInfo.LocalityCode
            status Status
            status_desc StatusDesc
            created_date CreatedDate as_is
            updated_date UpdatedDate instant
            ma_tb DHSXKDCustomerInfo.ma_tb
            ma_gd DHSXKDCustomerInfo.ma_gd
            ma_kh DHSXKDCustomerInfo.ma_kh
            ma_hd DHSXKDCustomerInfo.ma_hd
            ma_hrm DHSXKDCustomerInfo.ma_hrm
            credential_id CredentialId
            payment_order_id PaymentOrderId
            payment_status PaymentStatus
            payment_status_desc PaymentStatusDesc
            is_sync_dhsxkd IsSyncDHSXKD
            ma_gt MaGt
            pricing_name _pricing.Name
            pricing_code _pricing.tocdo_id
            code _pricing.Code
            sign_turn_number _turns
            total_money TotalMoney
        """,
    },
    patch="status status_desc updated_date payment_status payment_status_desc pricing_name"
    " pricing_code code sign_turn_number total_money",
    newest="updated_date created_date",
    born="created_date",
    required=lambda: F.col("CreatedDate").isNotNull(),
    derive=lambda run, labels: {
        "_pricing": last_item(F.col("Pricings")),
        # Without any pricing the turn count is 0, not blank.
        "_turns": F.when(
            F.coalesce(F.size("Pricings"), F.lit(0)) > 0,
            last_item(F.col("Pricings"))["SignTurnNumber"].cast("string"),
        ).otherwise("0"),
    },
)

REQUEST_CERT = Flow(
    collection="RequestCert",
    table="Cert",
    families={
        "info": """
            credential_id credentialId
            status status
            status_desc statusDesc
            client_id createdByClientId
            client_name createdByClientName
            updated_time updatedTime instant
            created_date createdDate as_is
            pricing_code pricingCode
            pricing_name pricingName
            username username
            locality_code _locality blank
            uid uid
            identity_id identityId
            full_name fullName
            period period
            code code
            approve_time approveTime instant
            request_type requestType
            request_type_desc requestTypeDesc
        """,
    },
    patch="status status_desc updated_time approve_time",
    newest="updated_time created_date",
    born="created_date",
    required=lambda: F.col("createdDate").isNotNull(),
    derive=lambda run, labels: {
        "_locality": F.when(is_space(F.col("username")), locality_from_username(F.col("username"))),
    },
)

CERT = Flow(
    collection="Cert",
    table="Cert",
    key="requestId",
    write="put",
    families={
        "cert": """
            cert_status status
            cert_status_desc statusDesc
            serial serial
            subject subject
            valid_from validFrom as_is
            valid_to validTo as_is
            cert_created_date createDate as_is
        """,
    },
    newest="cert_created_date",
    born="cert_created_date",
    required=lambda: (
        F.col("validFrom").isNotNull() & F.col("validTo").isNotNull() & F.col("createDate").isNotNull()
    ),
)

CREDENTIAL = Flow(
    collection="Credential",
    table="Credential",
    families={
        "info": """
            subject_dn subjectDN
            status status
            status_desc statusDesc
            created_date createdDate as_is
            modified_date modifiedDate instant
            identity_id identity._id
            full_name identity.name
            username identity.username
            email identity.email
            phone identity.phone
            uid identity.uid
            client_id identity.createdByClientId
            client_name identity.createdByClientName
            locality_code _locality blank
            ma_tb identity.DHSXKDSubcriptionCode
            source identity.source
            contract_number contract.number
            pricing_name contract.servicePack
            validity contract.validity
            pricing_code _pricing_code
            service_type contract.serviceType
            serial _cert.serial
            valid_from _cert.validFrom as_is
            valid_to _cert.validTo as_is
            request_cert_id _cert.requestId
            cert_status _cert_status blank
            cert_status_desc _cert_status_desc blank
        """,
    },
    patch="status status_desc modified_date serial valid_from valid_to request_cert_id"
    " cert_status cert_status_desc",
    newest="modified_date created_date",
    born="created_date",
    history=("status_log", "status"),
    keep=lambda labels: (
        ~mentions_test(F.col("identity.name"))
        & ~mentions_test(F.col("contract.servicePack"))
        & ~subject_mentions_test(F.col("subjectDN"))
    ),
    required=lambda: (
        F.col("createdDate").isNotNull()
        & F.col("contract").isNotNull()
        & F.col("identity").isNotNull()
        & (
            (F.coalesce(F.size("certs"), F.lit(0)) <= 0)
            | (
                last_item(F.col("certs"))["validFrom"].isNotNull()
                & last_item(F.col("certs"))["validTo"].isNotNull()
            )
        )
    ),
    derive=lambda run, labels: {
        "_cert": last_item(F.col("certs")),
        "_cert_status": expire(
            last_item(F.col("certs"))["validTo"], run.day_close, last_item(F.col("certs"))["status"], EXPIRED_STATUS
        ),
        "_cert_status_desc": expire(
            last_item(F.col("certs"))["validTo"], run.day_close, last_item(F.col("certs"))["statusDesc"], EXPIRED_DESC
        ),
        "_locality": F.when(
            is_space(F.col("identity.LocalityCode"))
            & F.col("identity.username").isNotNull()
            & ~is_space(F.col("identity.username")),
            locality_from_username(F.col("identity.username")),
        ).otherwise(F.col("identity.LocalityCode")),
        "_pricing_code": default_pricing(
            F.col("contract.pricingCode"), F.col("contract.servicePack"), labels.personal_packages
        ),
    },
)

SIGNATURE_TRANSACTION = Flow(
    collection="SignatureTransaction",
    table="SignatureTransaction",
    write="replace",
    families={
        "info": """
            serial certSerial
            credential_id credentialId
            identity_id identityId
            uid identityUid
            full_name identityName
            email identityEmail
            status status
            status_desc statusDesc
            req_time reqTime as_is
            expired_time expireTime instant
            finish_date finishDate instant
            tran_type_desc tranTypeDesc
            tran_type tranType
            execute_time excuteTime
            app_id appId
            app_name appName
            tran_code tranCode
        """,
    },
    newest="finish_date req_time",
    born="req_time",
    required=lambda: F.col("reqTime").isNotNull(),
)

PROBLEM_GUIDE = Flow(
    collection="ProblemGuide",
    table="ProblemGuide",
    families={
        "info": """
            error_message ErrorMessage
            guide_content GuideContent
            in_used InUsed
            status Status
            status_desc StatusDesc
            type_error type
            type_error_desc type_error_desc
            created_date _created as_is
        """,
    },
    patch="status status_desc type_error type_error_desc error_message guide_content",
    newest="created_date",
    born="created_date",
    derive=lambda run, labels: {"_created": real_instant_or(F.col("CreatedDate"), run.time_column)},
)

# Order of a daily ingest: both sources of a shared table follow each other.
DAILY = (REGISTER, USER, CERT_ORDER, PERSONAL_SIGN_TURN_ORDER, CREDENTIAL, REQUEST_CERT, CERT, SIGNATURE_TRANSACTION)
