"""Names, word lists and codes. Every function takes them as arguments; these are the defaults.

Fixed values: they must equal the ones the source systems and the stored models use.
"""

# --- raw sheets: heading as delivered -> our name (headings not listed stay) ---------------

LAYOUTTYPE_HEADINGS = {
    "Sort number": "Sort_Number",
    "Damage Code": "DamageCode",
    "Prob. code text": "DamageText",
    "Cause code": "CauseCode",
    "Cause code text": "CauseText",
}

ENGINEPROGRAM_HEADINGS = {"Coding code txt": "CodingText"}

SAP_HEADINGS = {
    "Created On": "Created_On",
    "Completed On": "Completed_On",
    "Task text": "TaskText",
    "Code group": "GroupCode",
    "Task group text": "GroupText",
    "Task code": "TaskCode",
    "Task code text": "TaskCodeText",
    "Planned start": "Planned_Start",
    "Planned finish": "Planned_Finish",
    "Supplier Vendor": "SupplierVendor",
    "Task Owner": "TaskOwner",
    "Task Status": "TaskStatus",
    "CATEGORY": "Category",
}

# --- record sets read by the cleaning job: service field -> our name -----------------------

SOURCE_FIELDS = {
    "GroupCode": {
        "CodeGroupId": "GroupCodeId",
        "CodeGroupName": "GroupCode",
        "CodeGroupText": "GroupText",
    },
    "CodingCode": {"CodingCodeName": "Coding", "CodingCodeText": "CodingText"},
    "SupplierVendor": {"SupplierVendorCode": "SupplierVendor"},
    "DamageCode": {"DamageCodeName": "DamageCode", "DamageCodeText": "DamageText"},
    "CauseCode": {},
    "TaskOwner": {"TaskOwnerCode": "TaskOwner"},
    "TaskStatus": {"TaskStatusCode": "TaskStatus"},
    "EngineProgram": {"NotificationCode": "Notification", "CodingCodeId": "Coding"},
    "Material": {"MaterialCode": "Material"},
    "LayoutType": {
        "NotificationId": "Notification",
        "ItemNumber": "Sort_Number",
        "LayoutText": "TaskText",
        "DamageCodeName": "DamageCode",
        "CauseCodeName": "CauseCode",
    },
    "TaskCode": {"TaskCodeName": "TaskCode", "GroupCodeName": "GroupCode"},
    "LayoutProcessingTask": {
        "NotificationCode": "Notification",
        "ItemNumber": "Item",
        "TaskId": "Task",
        "MaterialCode": "Material",
        "CreatedOn": "Created_On",
        "CompletedOn": "Completed_On",
        "PlannedStart": "Planned_Start",
        "PlannedFinish": "Planned_Finish",
        "CodeGroupId": "GroupCodeId",
    },
    "GeneralCode": {
        "CodeGroup": "Code_Group",
        "TaskCode": "Task_Code",
        "GeneralCode": "General_Code",
    },
    "Category": {"CategoryName": "Category"},
}

# --- cleaned task: our name -> name in the result ------------------------------------------

CLEANED_FIELDS = {
    "Notification": "notificationCode",
    "Item": "itemNumber",
    "LayoutTaskId": "layoutTaskId",
    "Task": "taskNumber",
    "Material": "materialCode",
    "Created_On": "createdDate",
    "Completed_On": "completedDate",
    "TaskText": "taskText",
    "TaskCodeId": "taskCodeId",
    "Planned_Start": "plannedStart",
    "Planned_Finish": "plannedFinish",
    "SupplierVendorId": "supplierVendorId",
    "TaskOwnerId": "taskOwnerId",
    "TaskStatusId": "taskStatusId",
    "DamageCodeId": "damageCodeId",
    "CauseCodeId": "causeCodeId",
    "GroupCodeId": "groupCodeId",
    "CategoryId": "categoryId",
    "Coding": "codingCodeId",
    "Engine": "engineProgram",
    "SupplierVendor": "supplierVendorCode",
    "TaskOwner": "taskOwnerCode",
    "TaskStatus": "taskStatusCode",
    "GroupCode": "groupCode",
    "CauseCode": "causeCode",
    "DamageCode": "damageCode",
    "Category": "category",
    "TaskCode": "taskCode",
    "TaskCodeText": "taskCodeText",
    "GeneralCode": "generalCode",
    "IsTaskCompleted": "isTaskCompleted",
    "IsItemCompleted": "isItemCompleted",
    "IsTurnback": "isTurnback",
    "IsLife": "isLife",
    "IsPlanning": "isPlanning",
    "Available": "available",
}

# --- similarity result: our name -> name in the result -------------------------------------

SIMILARITY_FIELDS = {
    "db_layout_id_ref": "LayoutIdRef",
    "db_layout_id_test": "LayoutIdTest",
    "Seq1": "TaskSequenceRef",
    "Seq2": "TaskSequenceTest",
    "Align_Seq1": "AlignTaskSequenceRef",
    "Align_Seq2": "AlignTaskSequenceTest",
}

# --- cleaning words and codes --------------------------------------------------------------

TURNBACK_WORDS = ("turnback", "return")
LIFE_WORDS = ("life",)
DROP_CODE_WORDS = ("delete", "inactive")
DROP_TEXT_WORDS = ("no demand",)
CLOSE_CODE_WORDS = ("expiry",)
CLOSE_TEXT_WORDS = ("expiry", "expire", "buffer", "life")
FAR_FUTURE = "2500-01-01"
PLANNING_CODES = ("tkat", "lpa", "vlml", "vlps", "psub")
PLANNING_GROUP = "flayout"
PLANNING_GROUP_CODES = ("0010", "0040", "0070", "0100", "0030", "0060", "0090", "0120")

# --- feature words, bins and limits --------------------------------------------------------

TEXT_FLAGS = {"IsExpiry": "expir", "IsPCE": "pce", "IsEval": "eval", "IsReceive": "receive"}
KEPT_VALUES = {
    "Engine": ("pt6", "pw1", "pw3"),
    "CauseCode": ("l055", "l070", "l020", "nan"),
    "DamageCode": ("10", "20", "30"),
    "SupplierVendor": ("7965", "1375", "9483", "2849", "1510"),
}
ENGINE_PREFIXES = ("pw", "pt")
FIRST_YEAR = 2015
LONG_TASK_DAYS = 30
SEED = 53

SELECTED_FEATURES = (
    "Item", "TaskOwnerExperience", "DaysFromItemStart", "DaysPerTask", "Task",
    "SupplierVendor_2849", "Seasonality", "DamageCode_30", "CauseCode_l055",
    "TaskCreatedMonth_7", "TaskCreatedMonth_2", "GeneralCode_ecpcrev", "TaskCreatedMonth_9",
    "GeneralCode_flayout_vend", "TaskCreatedMonth_4", "TaskCreatedMonth_10", "DamageCode_10",
    "Category_housing", "SupplierVendor_7965", "CauseCode_other", "Category_vane",
    "GeneralCode_flayout", "GeneralCode_flayout_0020", "Category_gearbox", "Coding_z010",
    "Coding_z020", "DamageCode_20", "TaskCreatedQuarter_3", "TaskCreatedMonth_3",
    "CauseCode_l070", "TaskCreatedMonth_6", "Category_blade", "Category_case",
    "TaskCreatedMonth_5", "IsEval_False", "GeneralCode_flayout_0110", "GeneralCode_epsto",
    "GeneralCode_ecmechan_0020", "GeneralCode_fpqcr_0060", "GeneralCode_ecturbin_0050",
    "GeneralCode_flayout_0080", "GeneralCode_eholdcod",
)

OUTLIER_COLUMNS = ("Item", "Task", "TaskDuration", "DaysFromItemStart")
