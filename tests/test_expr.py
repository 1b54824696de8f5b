import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import expr as X
from ledgerloom.functions import merkle


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [("0x1", 1), ("0xff", 255), ("0x0", 0), ("0x1234567890ABCDEF", 0x1234567890ABCDEF), ("100", 100), ("", None), ("xyz", None), ("0xGG", None), ("0x7fffffffffffffff", 2**63 - 1), ("0x8000000000000000", None), ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("-5", -5), ("010", None), ("0x", None), ("0X00000000000000000000001", 1), (None, None), ("1_0", None), ("0x" + "f" * 70, None)],
)
def test_to_int(spark, text, want):
    assert one(spark, text, X.to_int) == want


def test_hex_text(spark):
    assert one(spark, 255, X.to_hex, "long") == "0xff"
    assert [one(spark, x, X.normalize_hex) for x in ("", "0Xab", "ab", "0xab", None)] == ["", "0xab", "0xab", "0xab", None]
    assert one(spark, "5", lambda c: X.block_number(c, "string")) is None
    assert one(spark, 5.0, lambda c: X.block_number(c, "double"), "double") == 5
    assert one(spark, "9" * 77, X.decimal_view) is None


def test_fees_and_defaults(spark):
    df = spark.createDataFrame([("0", "1", "9"), ("2", "1", "9"), ("3", "1", "9")], "type string, price string, cap string")
    got = df.select(X.gas_price(F.col("type"), F.col("price"), F.col("cap")), X.fee_field(F.col("type"), F.col("cap"))).collect()
    assert [tuple(r) for r in got] == [("1", ""), ("9", "9"), ("1", "")]
    assert one(spark, None, X.sender) == X.ZERO_ADDRESS and one(spark, X.ZERO_ADDRESS, X.contract_address) == ""


def test_ids(spark):
    good = "bae-550e8400-e29b-41d4-a716-446655440000"
    packed = one(spark, good, X.doc_id_pack)
    assert bytes(packed).hex() == "550e8400e29b41d4a716446655440000" and one(spark, packed, X.doc_id_unpack, "binary") == good
    for bad in ("", "bae-", "550e8400-e29b-41d4-a716-446655440000", "bae-550e8400e29b41d4a716446655440000", good + "0", "bae-zz0e8400-e29b-41d4-a716-446655440000", None):
        assert one(spark, bad, X.doc_id_pack) is None
    both = one(spark, [good, good], X.doc_ids_pack, "array<string>")
    assert one(spark, both, X.doc_ids_unpack, "binary") == [good, good] and one(spark, [good, "x"], X.doc_ids_pack, "array<string>") is None
    assert one(spark, bytearray(b""), X.doc_ids_unpack, "binary") == [] and one(spark, bytearray(b"123"), X.doc_ids_unpack, "binary") is None


def tree(leaves):
    level = [hashlib.sha256(x).digest() for x in leaves]
    while len(level) > 1:
        level = [hashlib.sha256(level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else None


def test_roots_of_all_sizes(spark):
    rows = [(n, i, hashlib.sha256(f"{n}-{i}".encode()).digest()) for n in (*range(1, 34), 100) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i int, leaf binary").repartition(5)
    want = {n: tree([r[2] for r in rows if r[0] == n]) for n in (*range(1, 34), 100)}
    small = df.groupBy("g").agg(merkle.root(F.transform(F.array_sort(F.collect_list(F.struct("i", "leaf"))), lambda x: x["leaf"])).alias("root"))
    assert {r["g"]: bytes(r["root"]) for r in small.collect()} == want
    big = merkle.roots(df, ["g"], "i", "leaf", F.expr("i div 7"), chunk_bits=3)
    assert {r["g"]: bytes(r["root"]) for r in big.collect()} == want
    assert one(spark, [], merkle.root, "array<binary>") is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=8), min_size=2, max_size=9, unique=True))
def test_block_root_ignores_order_and_snapshot_root_does_not(spark, leaves):
    sorted_root = lambda xs: one(spark, xs, lambda c: merkle.root(F.array_sort(c)), "array<binary>")
    assert sorted_root(leaves) == sorted_root(leaves[::-1])
    plain = lambda xs: one(spark, xs, merkle.root, "array<binary>")
    assert plain(leaves) != plain(leaves[::-1])


def test_texts_are_packed_and_come_back(spark):
    """Hex takes half as many bytes on its way; any other text, null and emptiness come back as they were."""
    texts = ["0x" + "ab" * 32, "0xAB", "0xabc", "0x", "", None, "0xzz", "0xab\n", "\x01\x02", "\x00", "ab", "0xaé", "12", "123", "cd" * 32, "bae-0a", "0x" + "0f" * 100_000]
    rows = [(i, t, [t, "0xff"], {"a": t, "b": [{"c": t}]} if i % 2 else None, None if i % 3 else []) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string, a array<string>, s struct<a: string, b: array<struct<c: string>>>, e array<string>")
    packed = df.select(*(X.pack(F.col(f.name), f.dataType).alias(f.name) for f in df.schema))
    assert sorted(packed.select(*(X.unpack(F.col(f.name), f.dataType).alias(f.name) for f in df.schema)).collect()) == sorted(df.collect())
    sizes = {r.i: len(r.t) for r in packed.where("t is not null").collect()}
    assert sizes[0] == sizes[texts.index("cd" * 32)] == 33 and len({bytes(r.t) for r in packed.where("t is not null").collect()}) == len(texts) - 1
