"""Fixed names, allowed values and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column -> normalized target, in target order.
SOURCE_TO_TARGET = {
    "STUDY_ID": "studyId",
    "STUDY_SITE": "studySiteNumber",
    "SUBJECT_ID": "subjectId",
    "SUBJECT_STATUS": "subjectStatus",
    "VISIT_NUMBER": "subjectVisitNumber",
    "VISIT_NAME": "subjectVisitName",
    "VISIT_DATE": "subjectVisitDate",
    "STUDY_FSFV": "study_fsfv",
    "FORM_NAME": "formName",
    "BLANK_FORM_INDICATOR": "blankFormIndicator",
    "COHORT": "cohort",
    "STRATA": "strata",
    "FORM_NOTDONE_INDICATOR": "formNotDoneIndicator",
    "DATA_ENTRY_DATE": "dateEntryDate",
    "PROCEDURE_NAME": "procedureName",
    "PROCEDURE_STATUS": "procedureStatus",
    "SUBEVENT_NUMBER": "subEventNumber",
    "ERRONEOUS": "erroneous",
    "VISIT_CONTACT_MODE": "visitContactMode",
    "SUBJECT_GROUP_IDENTIFIER": "subjectGroupIdentifier",
    "START_DATETIME": "startDateTime",
    "TIME_POST_DOSE": "timePostDose",
    "PAYMENT_GROUP": "paymentGroup",
}
TARGETS = list(SOURCE_TO_TARGET.values())

# Extra source names understood in subject-group files.
GROUP_ALIASES = {
    "STUDY_SITE_NUMBER": "studySiteNumber",
    "SBJ_STR_STRATA_NUM": "strata",
    "SBJ_COH_COHORT_NUM": "cohort",
    "CREATION_TS": "dateEntryDate",
}

# Cell texts that mean "no value" in a delimited file.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# File categories.
SUBJECT_VISIT = "subject_visit"
SUBJECT_GROUP = "subject_group"
MISC = "misc"
CATEGORIES = [SUBJECT_VISIT, SUBJECT_GROUP, MISC]

# Allowed texts of the status, mode and rule columns.
RUN_STATUSES = ["PENDING", "PROCESSING", "INGESTED", "COMPLETED", "FAILED"]
ROW_STATUSES = ["VALID", "SKIPPED", "FAILED_ELIGIBILITY", "FAILED_STRATA", "FAILED_IMMUTABILITY"]
RULE_OPERATORS = [
    "EQUALS", "NOT_EQUALS", "IN", "NOT_IN", "GREATER_THAN", "LESS_THAN", "IS_NOT_NULL", "IS_NULL",
]
RULE_KINDS = ["NON_BLOCKING", "BLOCKING"]
DATA_SOURCES = ["API", "SFTP"]
SOURCE_MODES = ["API_FIRST", "SFTP_ONLY", "API_ONLY"]
DEPTHS = ["RAW", "STAGE", "PUBLISH"]
ENVIRONMENTS = ["local-compose", "local-localstack", "dev", "uat", "prod"]
RUNTIME_MODES = ["compose", "localstack_full"]
ARM_MODES = [
    "FLAT_RATE", "EDC_ONLY", "IMPALA_GROUP_MAP_TO_ARM", "MANUAL_MAPPING",
    "IMPALA_BUDGET_ARM_FROM_COLUMN", "HYBRID",
]
PAY_MODES = ["PER_TIMEPOINT", "LUMP_SUM", "IGNORE"]

# Label of the rows that came from the API, page size, sizes and limits.
API_LABEL = "subject_visits.csv"
PAGE_SIZE = 500
STEM_LIMIT = 200
PREVIEW_MAX = 100
PREVIEW_DEFAULT = 10


def _table(*columns: str) -> T.StructType:
    """Schema from ``name:type`` texts; ``s`` string, ``i`` int, ``b`` boolean, ``t`` timestamp."""
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "b": T.BooleanType(), "t": T.TimestampType()}
    pairs = [c.split(":") for c in columns]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


_CHANGE = ("createdAt:t", "createdBy:s", "updatedAt:t", "updatedBy:s", "isActive:b")

NORMALIZED = T.StructType([T.StructField(c, T.StringType()) for c in TARGETS])

COLUMN_MAPPING = _table(
    "id:i", "type:s", "sourceColumn:s", "targetColumn:s", "description:s", *_CHANGE
)
ELIGIBILITY_RULE = _table(
    "id:i", "ruleId:s", "studyId:s", "columnName:s", "operator:s", "expectedValue:s",
    "rejectionReason:s", "ruleKind:s", *_CHANGE,
)
STUDY_CONFIG = _table(
    "id:i", "studyId:s", "sponsorId:s", "armResolutionMode:s", "edcArmColumn:s",
    "payableSubjectStatuses:s", "nonPayableSubjectStatuses:s", "pkPayMode:s", "hasVisitContactMode:b",
    "impalaArmColumn:s", "impalaFileKey:s", "manualMappingFileKey:s", "strataToArmMapping:s", *_CHANGE,
)
SPONSOR_CONFIG = _table("id:i", "subjectVisitSourceMode:s", "isActive:b")
SUBJECT_REGISTRY = _table(
    "id:i", "studyId:s", "siteId:s", "subjectId:s", "assignedBudgetArm:s", "firstSeenRunId:s", *_CHANGE
)
VISIT_SCHEDULE = _table(
    "id:i", "studyId:s", "visitNumber:i", "visitName:s", "optionalVisitFlag:i", "formName:s",
    "procedureName:s", "fetchedAt:t", *_CHANGE,
)
RUN_LOG = _table(
    "id:i", "runId:s", "studyId:s", "sponsorId:s", "dataSource:s", "sourceFileKey:s", "stagingS3Key:s",
    "s3RawBucket:s", "s3PipelineStagingPrefix:s", "stagingS3Uri:s", "validatedValidS3Key:s",
    "validatedValidS3Uri:s", "validatedNonValidS3Key:s", "validatedNonValidS3Uri:s",
    "sourceEndpointUrl:s", "status:s", "totalRows:i", "validRows:i", "skippedRows:i",
    "failureReason:s", *_CHANGE,
)
# Row totals are 64-bit: one study may hold more rows than an int counts.
for _name in ("totalRows", "validRows", "skippedRows"):
    RUN_LOG[_name].dataType = T.LongType()
# The run log as it is written: with what a run found before it wrote.
RUN_LOG_COUNTS = T.StructType([*RUN_LOG.fields, *[T.StructField(c, T.LongType()) for c in ("rowsFetched", "filesAdded", "visitFilesSkipped")]])
FILE_LOG = _table(
    "id:i", "runId:s", "studyId:s", "sponsorId:s", "remotePath:s", "fileName:s", "mappingCategory:s",
    "fileNameHash:s", "fileContentHash:s", "sourceCreatedAt:t", "sourceUpdatedAt:t",
    "sourceAccessedAt:t", "createdAt:t",
)
