"""Array-of-struct expressions for detection boxes and JSON/base64 payloads.

A detection is ``struct<x1,y1,x2,y2,confidence: double, class_id: long, class_name: string>``.
Everything here is a higher-order SQL function (``filter``/``transform``/``size``), evaluated in the
JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOX_TYPE = T.StructType([
    T.StructField("x1", T.DoubleType()),
    T.StructField("y1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()),
    T.StructField("y2", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("class_id", T.LongType()),
    T.StructField("class_name", T.StringType()),
])
BOXES_TYPE = T.ArrayType(BOX_TYPE)

# Fixed values of the detector post-processing: keep class "person" (id 0) at confidence >= 0.35;
# coordinates are rounded to 2 decimals, confidence to 4.
PERSON_CLASS_ID = 0
MIN_CONFIDENCE = 0.35
COORD_SCALE = 2
CONF_SCALE = 4


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def box_count(boxes: str | Column) -> Column:
    """Number of detections; an empty array gives 0 and NULL stays NULL."""
    b = _col(boxes)
    return F.when(b.isNull(), F.lit(None).cast("long")).otherwise(F.size(b).cast("long"))


def keep_boxes(boxes: str | Column, class_id: int = PERSON_CLASS_ID,
               min_confidence: float = MIN_CONFIDENCE) -> Column:
    """Detections of one class at or above a confidence threshold."""
    return F.filter(_col(boxes), lambda b: (b["class_id"] == F.lit(class_id))
                    & (b["confidence"] >= F.lit(min_confidence)))


def round_boxes(boxes: str | Column, coord_scale: int = COORD_SCALE,
                conf_scale: int = CONF_SCALE) -> Column:
    """Rebuild each detection with rounded coordinates and confidence."""
    def rebuild(b: Column) -> Column:
        return F.struct(
            F.round(b["x1"], coord_scale).alias("x1"),
            F.round(b["y1"], coord_scale).alias("y1"),
            F.round(b["x2"], coord_scale).alias("x2"),
            F.round(b["y2"], coord_scale).alias("y2"),
            F.round(b["confidence"], conf_scale).alias("confidence"),
            b["class_id"].alias("class_id"),
            b["class_name"].alias("class_name"),
        )
    return F.transform(_col(boxes), rebuild)


def to_payload(*cols: str | Column) -> Column:
    """Serialise columns to one JSON text value (the message body of a topic/file sink)."""
    return F.to_json(F.struct(*[_col(c) for c in cols]))


def from_payload(c: str | Column, schema: T.StructType | str) -> Column:
    """Parse a JSON message body with an explicit schema (bad JSON -> NULL fields)."""
    return F.from_json(_col(c), schema)


def decode_base64(c: str | Column) -> Column:
    """Base64 text -> binary; undecodable text gives NULL instead of failing the batch."""
    return F.try_to_binary(_col(c), F.lit("base64"))


def encode_base64(c: str | Column) -> Column:
    """Binary -> RFC 4648 base64 text on one line (Spark may chunk ``base64`` output into
    76-character MIME lines; message payloads must not contain line breaks)."""
    return F.regexp_replace(F.base64(_col(c)), "[\r\n]", "")
