"""Schemas of the document collections and the windowed scans over them.

``format`` is any Spark source that yields these columns: Parquet or JSON dumps,
or a document-store connector on the class path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.windows import half_open, touched_in

# Field names and types of the collections, as the documents have them.
ADDRESS = (
    "struct<provinceId:string,provinceName:string,districtId:string,districtName:string,"
    "wardId:string,wardName:string,streetName:string,address:string>"
)
CUSTOMER_INFO = "struct<ma_tb:string,ma_gd:string,ma_kh:string,ma_hd:string,ma_hrm:string>"

SCHEMAS = {
    "CertOrder": f"""
        _id string, FullName string,
        Pricing struct<PricingCode:string,PricingName:string,Price:string,Code:string,SignType:string,Validity:string>,
        DHSXKDCustomerInfo {CUSTOMER_INFO},
        Status int, StatusDesc string, CreatedDate timestamp, UpdatedDate timestamp,
        Logs array<struct<IsError:string,Content:string,CreatedDate:timestamp>>,
        AcceptanceDocuments array<struct<UrlSigned:string>>,
        CredentialId string, RequestCertId string, ContractUrl string, Serial string, PreviousSerial string,
        IdentityId string, Uid string, Email string, Phone string, LocalityCode string,
        Type string, TypeDesc string, ClientName string, ClientId string, Source string, MaGt string,
        Address {ADDRESS}""",
    "Register": """
        _id string, status int, statusDesc string, modifiedDate timestamp, createdDate timestamp,
        fullName string, email string, phone string, uid string, source string,
        address struct<provinceId:string,districtId:string,wardId:string,streetName:string,address:string>""",
    "User": f"""
        _id string, status int, statusDesc string, modifiedDate timestamp, createDate timestamp,
        provinceCode string, provinceCodes array<struct<name:string>>, roles array<struct<name:string>>,
        preStatus string, uid string, username string, fullName string, email string, phone string,
        localityId string, uidPrefix string, userGroupId string, accountType string, accountTypeDesc string,
        isTest boolean, isComAdmin boolean, source string, identityAddress {ADDRESS}""",
    "PersonalSignTurnOrder": f"""
        _id string, Status int, StatusDesc string, CreatedDate timestamp, UpdatedDate timestamp,
        PaymentStatus string, PaymentStatusDesc string, TotalMoney string,
        Pricings array<struct<Name:string,tocdo_id:string,Code:string,SignTurnNumber:int>>,
        UserInfo struct<_id:string,Uid:string,FullName:string,LocalityCode:string>,
        DHSXKDCustomerInfo {CUSTOMER_INFO},
        CredentialId string, PaymentOrderId string, IsSyncDHSXKD string, MaGt string""",
    "RequestCert": """
        _id string, status string, statusDesc string, updatedTime timestamp, approveTime timestamp,
        createdDate timestamp, credentialId string, createdByClientId string, createdByClientName string,
        pricingCode string, pricingName string, username string, uid string, identityId string,
        fullName string, period string, code string, requestType string, requestTypeDesc string""",
    "Cert": """
        requestId string, serial string, status string, statusDesc string, subject string,
        validFrom timestamp, validTo timestamp, createDate timestamp""",
    "Credential": """
        _id string,
        identity struct<_id:string,name:string,email:string,phone:string,username:string,uid:string,
            createdByClientId:string,createdByClientName:string,LocalityCode:string,
            DHSXKDSubcriptionCode:string,source:string>,
        contract struct<servicePack:string,number:string,validity:string,pricingCode:string,serviceType:string>,
        subjectDN string, status string, statusDesc string, createdDate timestamp, modifiedDate timestamp,
        certs array<struct<status:string,statusDesc:string,validFrom:timestamp,validTo:timestamp,
            requestId:string,serial:string>>""",
    "SignatureTransaction": """
        _id string, credentialId string, certSerial string, identityId string, identityUid string,
        identityName string, identityEmail string, status string, statusDesc string, reqTime timestamp,
        expireTime timestamp, finishDate timestamp, tranTypeDesc string, tranType string,
        excuteTime string, appId string, appName string, tranCode string""",
    "CutOff": "sourceCollection string, collectionName string, fromTime timestamp, toTime timestamp",
    "AreaLocal": "code string, name string, localities array<struct<code:string,name:string,otherCode:string>>",
    "ProblemGuide": """
        _id string, ErrorMessage string, GuideContent string, InUsed string, Status string,
        StatusDesc string, type string, type_error_desc string, CreatedDate timestamp""",
}

# The fields each collection is windowed by (created, updated).
WINDOW_FIELDS = {
    "CertOrder": ("CreatedDate", "UpdatedDate"),
    "Register": ("createdDate", "modifiedDate"),
    "User": ("createDate", "modifiedDate"),
    "PersonalSignTurnOrder": ("CreatedDate", "UpdatedDate"),
    "RequestCert": ("createdDate", "updatedTime"),
    "Cert": ("createDate", None),
    "Credential": ("createdDate", "modifiedDate"),
    "SignatureTransaction": ("reqTime", None),
}


def read_collection(
    spark: SparkSession, collection: str, *paths: str, format: str = "parquet", schema: str | None = None
) -> DataFrame:
    """Full scan with the declared schema; nothing is inferred."""
    return spark.read.schema(schema or SCHEMAS[collection]).format(format).load(list(paths))


def in_window(documents: DataFrame, collection: str, start: Column, end: Column) -> DataFrame:
    """Windowed scan: touched since ``start``, or only created in it where no update time is kept."""
    created, updated = WINDOW_FIELDS[collection]
    if updated is None:
        return documents.filter(half_open(F.col(created), start, end))
    return documents.filter(touched_in(F.col(created), F.col(updated), start, end))
