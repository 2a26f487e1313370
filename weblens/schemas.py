"""Schemas of the tables this library reads and writes."""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()

LINE = _struct(value=_S)
REJECT = _struct(value=_S, reason=_S)

CLEAN_ACCESS = _struct(
    url=_S, cmsType=_S, cmsId=_L, traffic=_L, ip=_S, city=_S, time=_S, day=_S)
PAGE_VIEW = _struct(date=_S, url=_S, guid=_S)
KEY_VALUE = _struct(key=_S, value=_I)
CLICK = _struct(ip=_S, time=_S, courseId=_I, statusCode=_I, referer=_S)
TAXI = _struct(id=_I, lat=_S, lon=_S, time=_S)
PERSON = _struct(name=_S, grade=_I)
GRADED_PERSON = _struct(id=_I, name=_S, grade=_D)
IP_RANGE = _struct(lo=_L, hi=_L, region=_S)

DAY_VIDEO = _struct(day=_S, cms_id=_L, times=_L)
DAY_CITY_VIDEO = _struct(day=_S, cms_id=_L, city=_S, times=_L, times_rank=_I)
DAY_TRAFFIC = _struct(day=_S, cms_id=_L, traffics=_L)

# Counter and cell tables, and their markers; partition columns come last.
COUNTER_DELTA = _struct(row_key=_S, delta=_L, stream_id=_S, batch_id=_L, attempt=_I, key_day=_S)
COUNTER_BASE = _struct(row_key=_S, value=_L, generation=_I, key_day=_S)
BATCH_COMMIT = _struct(attempt=_I, lines=_L, rejects=_L, stream_id=_S, batch_id=_L)
FOLDED = _struct(generation=_I, key_day=_S, stream_id=_S, batch_id=_L)
CELL_VERSION = _struct(row_key=_S, segment=_S, value=_L, epoch=_L, stream_id=_S, version=_L, key_day=_S)
CELL_STREAM = _struct(epoch=_L, stream_id=_S)

# The tables of the daily statistics.
STATS = {"video": DAY_VIDEO, "city": DAY_CITY_VIDEO, "traffic": DAY_TRAFFIC}

# Which run of the daily statistics holds a day.
STAT_RUN = _struct(day=_S, run=_L)
