"""Values the reports use unless the caller passes others."""

# First year read by the daily issue counts and the stage history.
MIN_YEAR = "2025"

# Output column and error-code key of the daily issue counts.
ISSUE_TAGS = {
    "wrong_tool": "Wrong Tool",
    "wrong": "Wrong",
    "tmp_01": "TMP-01 | Timestamp Outside Window",
    "tag_01": "TAG-01 | Missing or Wrong Tag",
    "rec_01": "REC-01 | Missed Event",
    "pre_01": "PRE-01 | False Positive",
    "qa_001": "QA-001",
    "missing_wrong_attribute": "Missing/Wrong Attribute",
    "missing": "Missing",
    "missing_tool": "Missing Tool",
    "cls_01": "CLS-01 | Wrong Class",
    "atr_03": "ATR-03 | Wrong Soil Humidity",
    "atr_01": "ATR-01 | Wrong Soil Type",
}

# Stage names counted as one stage, under their common label.
STAGE_LABELS = {"Audit": ["Client Audit", "Client Bulk Audit"]}

# Classes and object types with a minutes-per-object column of
# their own, named <key>_tpo.
OBJECT_CLASSES = [
    "vehicle",
    "person",
    "unlabel",
    "trailer",
    "bulldozer",
    "dump_truck_cab",
    "dump_truck_trailer",
    "dump_truck_bed_or_trailer",
    "water_truck_cab",
    "other_construction_vehicle",
    "dump_truck_bed",
    "water_truck_trailer",
]
OBJECT_TYPES = ["cuboid"]
