"""The thirteen entities: table, names, load key, foreign keys, place in the load order."""

from __future__ import annotations

from dataclasses import dataclass, field

from taskspark.operators.keys import Lookup


@dataclass(frozen=True)
class Entity:
    """How one entity goes from its file into its table."""

    name: str
    table: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    rename: dict[str, str] = field(default_factory=dict)
    lookups: tuple[Lookup, ...] = ()
    dates: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    order: int = 0
    enabled: bool = True


ENTITIES = {
    e.name: e
    for e in (
        Entity("GroupCode", "CodeGroup", ("GroupCode", "GroupText"), ("GroupCode", "GroupText")),
        Entity("CodingCode", "CodingCode", ("Coding", "CodingText"), ("Coding", "CodingText")),
        Entity(
            "DamageCode", "DamageCode", ("DamageCode", "DamageText"), ("DamageCode", "DamageText")
        ),
        Entity("CauseCode", "CauseCode", ("CauseCode", "CauseText"), ("CauseCode", "CauseText")),
        Entity(
            "TaskOwner", "TaskOwner", ("TaskOwner",), ("TaskOwner_Id",),
            rename={"TaskOwner": "TaskOwner_Id"},
        ),
        Entity("TaskStatus", "TaskStatus", ("TaskStatus",), ("TaskStatus",)),
        Entity(
            "SupplierVendor", "SupplierVendor", ("SupplierVendor",), ("SupplierVendor_Id",),
            rename={"SupplierVendor": "SupplierVendor_Id"},
        ),
        Entity(
            "Category", "Category", ("Category",), ("CategoryName",),
            rename={"Category": "CategoryName"},
        ),
        Entity(
            "TaskCode", "TaskCode", ("TaskCode", "TaskCodeText", "GroupCode"),
            ("TaskCode", "TaskCodeText", "GroupCode"),
            lookups=(Lookup("GroupCode", {"GroupCode": "GroupCode"}, "GroupCode"),),
            order=1,
        ),
        Entity(
            "Material", "Material", ("Material", "Description", "Category"),
            ("Material_Id", "Description", "Category_Id"),
            rename={"Material": "Material_Id", "Category": "CategoryName"},
            lookups=(Lookup("Category", {"CategoryName": "CategoryName"}, "Category_Id"),),
            order=1,
        ),
        Entity(
            "EngineProgram", "EngineProgram", ("Notification", "Coding", "Description"),
            ("Notification_Id", "Description", "CodingCode"),
            rename={"Notification": "Notification_Id"},
            lookups=(Lookup("CodingCode", {"Coding": "Coding"}, "CodingCode"),),
            order=2,
        ),
        Entity(
            "LayoutType", "LayoutType",
            ("Notification", "Sort_Number", "Text", "DamageCode", "CauseCode"),
            ("Notification_Id", "Item_Number", "Layout_Text", "DamageCode", "CauseCode"),
            rename={"Sort_Number": "Item_Number", "Text": "Layout_Text"},
            lookups=(
                Lookup("EngineProgram", {"Notification": "Notification_Id"}, "Notification_Id"),
                Lookup("DamageCode", {"DamageCode": "DamageCode"}, "DamageCode", required=False),
                Lookup("CauseCode", {"CauseCode": "CauseCode"}, "CauseCode", required=False),
            ),
            order=3,
        ),
        Entity(
            "LayoutTask", "LayoutProcessingTasks",
            (
                "Notification", "Item", "Task", "Material", "Created_On", "Completed_On",
                "TaskText", "GroupCode", "TaskCode", "Planned_Start", "Planned_Finish",
                "SupplierVendor", "TaskOwner", "TaskStatus",
            ),
            ("Layout_Id", "Task_Id"),
            rename={"Task": "Task_Id", "TaskText": "Task_Text"},
            lookups=(
                Lookup(
                    "LayoutType",
                    {"Notification": "Notification_Id", "Item": "Item_Number"},
                    "Layout_Id",
                ),
                Lookup("Material", {"Material": "Material_Id"}, "Material_Id"),
                Lookup("TaskOwner", {"TaskOwner": "TaskOwner_Id"}, "Task_Owner_Id"),
                Lookup(
                    "SupplierVendor", {"SupplierVendor": "SupplierVendor_Id"}, "SupplierVendor_Id"
                ),
                Lookup("TaskStatus", {"TaskStatus": "TaskStatus"}, "Task_Status_Id"),
                # A code may have several texts in a group, and so several ids.
                Lookup(
                    "TaskCode", {"TaskCode": "TaskCode", "GroupCode": "GroupCode"}, "Task_Code_Id",
                    several=True,
                ),
            ),
            dates=("Created_On", "Completed_On", "Planned_Start", "Planned_Finish"),
            order=4,
        ),
    )
}
