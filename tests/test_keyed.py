"""P1 building block: HMAC-SHA-256 as Spark expressions (RFC 4231 vectors)."""

import hashlib
import hmac

from pyspark.sql import functions as F

from laketide.functions import keyed
from laketide.operators.privacy import pseudonymise

# RFC 4231 test cases 1, 2, 3, 4, 6 and 7 (6 and 7 use a 131-byte key,
# longer than one block): (key, data, HMAC-SHA-256).
RFC4231 = [
    (bytes.fromhex("0b" * 20), b"Hi There",
     "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
    (b"Jefe", b"what do ya want for nothing?",
     "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
    (bytes.fromhex("aa" * 20), bytes.fromhex("dd" * 50),
     "773ea91e36800e46854db8ebd09181a72959098b3ef8c122d9635514ced565fe"),
    (bytes.fromhex("0102030405060708090a0b0c0d0e0f10111213141516171819"), bytes.fromhex("cd" * 50),
     "82558a389a443c0ea4cc819899f2083a85f0faa3e578f8077a2e3ff46729665b"),
    (bytes.fromhex("aa" * 131), b"Test Using Larger Than Block-Size Key - Hash Key First",
     "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
    (bytes.fromhex("aa" * 131),
     b"This is a test using a larger than block-size key and a larger than block-size data. "
     b"The key needs to be hashed before being used by the HMAC algorithm.",
     "9b09ffa71b942fcb27635fbcd5b0e944bfdc63644f0713938a7f51535c3a35e2"),
]


def test_rfc4231_vectors(spark):
    for key, data, mac in RFC4231:
        pads = keyed.pads_of(keyed.key_table(spark, key))
        msg = spark.createDataFrame([(bytearray(data),)], "m binary")
        got = msg.select(keyed.hmac_hex(F.col("m"), pads).alias("mac")).first()["mac"]
        assert got == mac


def test_null_and_empty_message(spark):
    key = b"k" * 32
    pads = keyed.pads_of(keyed.key_table(spark, key))
    df = spark.createDataFrame([(None,), (bytearray(b""),)], "m binary")
    got = [r["mac"] for r in df.select(keyed.hmac_hex(F.col("m"), pads).alias("mac")).collect()]
    assert got[0] is None
    assert got[1] == hmac.new(key, b"", hashlib.sha256).hexdigest()


def test_tokens_equal_python_hmac_and_are_stable(spark):
    key = b"another test key"
    df = spark.range(200).select(F.col("id").alias("c"))
    a = pseudonymise(df, ["c"], keyed.key_table(spark, key), "customer").collect()
    b = pseudonymise(df, ["c"], keyed.key_table(spark, key), "customer").collect()
    assert a == b
    for i, r in enumerate(a):
        assert r["c"] == hmac.new(key, f"token:8:customer:{i}".encode(), hashlib.sha256).hexdigest()
    assert len({r["c"] for r in a}) == 200  # injective on the data


def test_other_key_or_domain_gives_other_tokens(spark):
    df = spark.range(50).select(F.col("id").alias("c"))
    t1 = {r["c"] for r in pseudonymise(df, ["c"], keyed.key_table(spark, b"key one"), "customer").collect()}
    t2 = {r["c"] for r in pseudonymise(df, ["c"], keyed.key_table(spark, b"key two"), "customer").collect()}
    t3 = {r["c"] for r in pseudonymise(df, ["c"], keyed.key_table(spark, b"key one"), "supplier").collect()}
    assert not (t1 & t2) and not (t1 & t3)


def test_null_identifier_stays_null(spark):
    df = spark.createDataFrame([(None,), (7,)], "c bigint")
    got = pseudonymise(df, ["c"], keyed.key_table(spark, b"k"), "customer").collect()
    assert got[0]["c"] is None and len(got[1]["c"]) == 64


def test_key_bytes_never_in_plan(spark):
    key = bytes(range(1, 33))
    df = pseudonymise(spark.range(10).select(F.col("id").alias("c")), ["c"],
                      keyed.key_table(spark, key), "customer")
    plans = [df._jdf.queryExecution().toString(), df._jdf.queryExecution().executedPlan().toString()]
    for p in plans:
        for needle in (key.hex(), key.hex().upper(), bytes(b ^ 0x36 for b in key).hex()):
            assert needle not in p


def test_derived_workspace_key_is_hmac_of_label(spark):
    main = b"main lake key"
    derived = keyed.derive_key_table(keyed.key_table(spark, main), "workspace:ws1").first()["key"]
    assert bytes(derived) == hmac.new(main, b"derive:workspace:ws1", hashlib.sha256).digest()


def test_key_read_from_a_table_gets_pads(spark):
    # a key table without pads (as read from a protected path) works the same
    key = b"stored key"
    raw = spark.createDataFrame([(bytearray(key),)], "key binary")
    a = pseudonymise(spark.range(5).select(F.col("id").alias("c")), ["c"], raw, "customer").collect()
    b = pseudonymise(spark.range(5).select(F.col("id").alias("c")), ["c"], keyed.with_pads(raw),
                     "customer").collect()
    assert a == b
    assert a[3]["c"] == hmac.new(key, b"token:8:customer:3", hashlib.sha256).hexdigest()


def test_message_spaces_do_not_meet(spark):
    """No token equals a derived key, and a domain cannot run into its value."""
    key = keyed.key_table(spark, b"main lake key")
    df = spark.createDataFrame([("workspace:research", "b|c")], "a string, b string")
    derived = bytes(keyed.derive_key_table(key, "workspace:research").first()["key"]).hex()
    for domain in ("derive", "", "derive:"):
        assert pseudonymise(df, ["a"], key, domain).first()["a"] != derived
    one = df.select(keyed.token(F.lit("b|c"), "a", keyed.pads_of(key)).alias("t")).first()["t"]
    two = df.select(keyed.token(F.lit("c"), "a|b", keyed.pads_of(key)).alias("t")).first()["t"]
    three = df.select(keyed.token(F.lit("c"), "a:b", keyed.pads_of(key)).alias("t")).first()["t"]
    assert len({one, two, three}) == 3
