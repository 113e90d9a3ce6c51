"""Shape of a register record, of its raw (all-text) form and of the derived members.

Fixed values: the field names below are the public tag names of the register's
data set and have to be spelled exactly like this.
"""

from __future__ import annotations

from pyspark.sql import types as T

CERTIFICATE_FIELDS = [
    "Id", "IsFederal", "StatusName", "TypeName", "RegionName", "RegionCode",
    "FederalDistrictName", "FederalDistrictShortName", "RegNumber", "SerialNumber",
    "FormNumber", "IssueDate", "EndDate", "ControlOrgan", "PostAddress",
    "EduOrgFullName", "EduOrgShortName", "EduOrgINN", "EduOrgKPP", "EduOrgOGRN",
    "IndividualEntrepreneurLastName", "IndividualEntrepreneurFirstName",
    "IndividualEntrepreneurMiddleName", "IndividualEntrepreneurAddress",
    "IndividualEntrepreneurEGRIP", "IndividualEntrepreneurINN",
]
SUPPLEMENT_FIELDS = [
    "Id", "StatusName", "StatusCode", "Number", "SerialNumber", "FormNumber",
    "IssueDate", "IsForBranch", "Note", "EduOrgFullName", "EduOrgShortName",
    "EduOrgAddress", "EduOrgKPP",
]
DECISION_FIELDS = [
    "Id", "DecisionTypeName", "OrderDocumentNumber", "OrderDocumentKind", "DecisionDate",
]
PROGRAM_FIELDS = [
    "Id", "TypeName", "EduLevelName", "ProgrammName", "ProgrammCode", "UGSName",
    "UGSCode", "EduNormativePeriod", "Qualification", "IsAccredited", "IsCanceled",
    "IsSuspended",
]
ORGANIZATION_FIELDS = [
    "Id", "FullName", "ShortName", "HeadEduOrgId", "IsBranch", "PostAddress", "Phone",
    "Fax", "Email", "WebSite", "OGRN", "INN", "KPP", "HeadPost", "HeadName", "FormName",
    "KindName", "TypeName", "RegionName", "FederalDistrictShortName", "FederalDistrictName",
]

BOOL_FIELDS = {"IsFederal", "IsBranch", "IsForBranch", "IsAccredited", "IsCanceled", "IsSuspended"}
DATE_FIELDS = {"IssueDate", "EndDate", "DecisionDate"}
ID_NUMBER_FIELDS = {
    "INN", "KPP", "OGRN", "EduOrgINN", "EduOrgKPP", "EduOrgOGRN",
    "IndividualEntrepreneurINN", "IndividualEntrepreneurEGRIP",
}
CODE_FIELDS = {"ProgrammCode", "UGSCode"}

# wrapper element -> item element
WRAPPERS = {
    "Supplements": "Supplement",
    "Decisions": "Decision",
    "EducationalPrograms": "EducationalProgram",
}
ORGANIZATION = "ActualEducationOrganization"

# derived members, kept next to the untouched originals
CERTIFICATE_DERIVED = {"EduOrgINN": "string", "EduOrgOGRN": "string", "HasBranchSupplements": "boolean"}
SUPPLEMENT_DERIVED = {"IsBranchSupplement": "boolean"}
ORGANIZATION_DERIVED = {"INN": "string", "OGRN": "string", "KPP": "string"}
PROGRAM_DERIVED = {"EduLevelName": "string"}


def _scalar(name: str, raw: bool) -> T.DataType:
    return T.BooleanType() if name in BOOL_FIELDS and not raw else T.StringType()


def _struct(fields: list[str], raw: bool, derived: dict[str, str] | None = None, extra=()) -> T.StructType:
    out = T.StructType([T.StructField(f, _scalar(f, raw)) for f in fields])
    for name, dtype in extra:
        out = out.add(name, dtype)
    if derived and not raw:
        out = out.add("_derived", T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in derived.items())))
    return out


def organization_type(raw: bool = False) -> T.StructType:
    return _struct(ORGANIZATION_FIELDS, raw, ORGANIZATION_DERIVED)


def program_type(raw: bool = False) -> T.StructType:
    return _struct(PROGRAM_FIELDS, raw, PROGRAM_DERIVED)


def decision_type(raw: bool = False) -> T.StructType:
    return _struct(DECISION_FIELDS, raw)


def supplement_type(raw: bool = False) -> T.StructType:
    return _struct(
        SUPPLEMENT_FIELDS, raw, SUPPLEMENT_DERIVED,
        [(ORGANIZATION, organization_type(raw)), ("EducationalPrograms", T.ArrayType(program_type(raw)))],
    )


def record_type(raw: bool = False) -> T.StructType:
    """Typed record (``raw=False``) or the all-text record a source hands over."""
    return _struct(
        CERTIFICATE_FIELDS, raw, CERTIFICATE_DERIVED,
        [
            (ORGANIZATION, organization_type(raw)),
            ("Supplements", T.ArrayType(supplement_type(raw))),
            ("Decisions", T.ArrayType(decision_type(raw))),
        ],
    )


def xml_row_type() -> T.StructType:
    """Row type of the XML source: like the raw record, but with the wrapper elements in place."""
    sup = _struct(
        SUPPLEMENT_FIELDS, True, None,
        [
            (ORGANIZATION, organization_type(True)),
            ("EducationalPrograms", T.StructType().add("EducationalProgram", T.ArrayType(program_type(True)))),
        ],
    )
    return _struct(
        CERTIFICATE_FIELDS, True, None,
        [
            (ORGANIZATION, organization_type(True)),
            ("Supplements", T.StructType().add("Supplement", T.ArrayType(sup))),
            ("Decisions", T.StructType().add("Decision", T.ArrayType(decision_type(True)))),
            ("_corrupt_record", T.StringType()),
        ],
    )


SCHEMA_TAGS = sorted(
    {"OpenData", "Certificates", "Certificate", ORGANIZATION}
    | set(WRAPPERS) | set(WRAPPERS.values())
    | set(CERTIFICATE_FIELDS) | set(SUPPLEMENT_FIELDS) | set(DECISION_FIELDS)
    | set(PROGRAM_FIELDS) | set(ORGANIZATION_FIELDS)
)
