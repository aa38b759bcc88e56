"""Declared schemas of the lake's tables (types as Spark reads the Parquet).

Reads pass these schemas instead of inferring them, so no footer-reading
job runs per read, and a file whose types drift from the declaration fails
the read instead of changing a job's meaning.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

_TYPES = {"int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "string": StringType(),
          "timestamp_ntz": TimestampNTZType(), "array<float>": ArrayType(FloatType())}


def _s(columns: str) -> StructType:
    """``"name type, name type"`` to a StructType (no JVM needed at import)."""
    fields = [c.strip().split(" ", 1) for c in columns.split(",")]
    return StructType([StructField(n, _TYPES[t.strip()], True) for n, t in fields])


TABLES: dict[str, StructType] = {
    "region": _s("r_regionkey int, r_name string"),
    "nation": _s("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _s("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                   "c_mktsegment string"),
    "supplier": _s("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _s("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
               "p_retailprice double"),
    "orders": _s("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": _s("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                   "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                   "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": _s("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string"),
    "documents": _s("doc_id bigint, text string, lang string, source string, n_chars bigint"),
    "pages": _s("page_id bigint, url string, html string"),
    "embeddings": _s("vec_id bigint, embedding array<float>, label int"),
    "benchmark": _s("item_id bigint, text string"),
    "labels": _s("doc_id bigint, quality int, toxic int"),
    "conversations": _s("conv_id bigint, turn bigint, role string, text string"),
}
