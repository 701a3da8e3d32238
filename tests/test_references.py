"""Orphan references, and hot keys."""

import datetime as dt

from pyspark.sql import functions as F

from lexgrain.operators import references
from lexgrain.plans import scale

T = [dt.datetime(2020, 1, d) for d in range(1, 10)]
REFS = "ref_id long, source_node_id string, destination_urn string, created_at timestamp_ntz, key string, cause string"
NODES = "node_id string, loaded_at timestamp_ntz, created_at timestamp_ntz"
ACTS = "doc_id string, urn string, akn_uri string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz, key string"


def frames(spark):
    acts = [
        ("1", "urn:a;1", "/akn/it/act/a/italia/1", T[0], T[0], None, "k"), ("1", "urn:old", None, T[8], T[0] - dt.timedelta(1), None, "k"),
        ("2", "urn:b;2", "/akn/b", T[0], T[1], None, "k"), ("2", "urn:b;2", "/akn/b", T[0], T[2], T[2], "k"), ("3", "URN:C@x", None, T[5], T[5], None, "k"), (None, "urn:none", None, T[0], T[0], None, "k"),
    ]
    nodes = [("n1", T[3], T[0]), ("n1", T[1], T[0]), ("n2", T[6], T[0]), (None, T[0], T[0])]
    refs = [
        (1, "n1", "urn:a;1", T[2]), (2, "n2", " URN:A;1 ", T[2]), (3, "nx", "urn:a;1#art5", T[2]), (4, None, None, T[2]), (5, "n1", " ", T[2]), (6, "n1", "urn:b;2~art1", T[2]),
        (7, "n1", "urn:c@x@2020", T[2]), (8, "n1", "urn:c", T[2]), (9, "n1", "/akn/it/act/a/italia/1/ita@2020/!main#x", T[2]), (10, "n1", "urn:a;12", T[2]), (11, "n2", "urn:old", None), (12, "N1", "urn:none", T[2]),
        (1, "n1", "urn:a;1", T[2]),
    ]
    return spark.createDataFrame([(*r, "k", "c") for r in refs], REFS), spark.createDataFrame(nodes, NODES), spark.createDataFrame(acts, ACTS)


WANT = {
    (2, "source_node_id", "late"), (3, "source_node_id", "missing"), (4, "source_node_id", "missing"), (12, "source_node_id", "missing"),
    (6, "destination_urn", "deleted"), (7, "destination_urn", "late"), (8, "destination_urn", "missing"), (10, "destination_urn", "missing"), (11, "destination_urn", "missing"), (12, "destination_urn", "missing"),
}


def test_causes(spark):
    got = [tuple(r) for r in references.orphans(*frames(spark)).select("ref_id", "ref_field", "cause").collect()]
    assert len(got) == len(set(got)) and set(got) == WANT


def test_report_counts_by_table_and_month(spark):
    got = {tuple(r) for r in references.orphan_report(*frames(spark)).collect()}
    assert ("acts", "2020-01", "missing", 3) in got and ("acts", "", "missing", 1) in got and ("nodes", "2020-01", "missing", 3) in got


def test_empty_tables(spark):
    refs, nodes, acts = frames(spark)
    assert references.orphans(refs.limit(0), nodes, acts).count() == 0
    got = references.orphans(refs, nodes.limit(0), acts.limit(0)).select("ref_id", "ref_field", "cause").distinct()
    assert got.where("cause <> 'missing'").count() == 0 and got.count() == 22


def test_salted_join_equals_a_plain_one(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    left = left.unionByName(spark.createDataFrame([(-1, None)], "id long, key string"))
    right = spark.createDataFrame([("hot", 1), ("7", 2), ("zz", 3)], "key string, v int")
    assert scale.hot_values(left, "key", least=100) == ["hot"]
    got = sorted(map(tuple, scale.salted_left_join(left, right, "key", F.col("id"), least=100, salts=4).select("id", "key", "v").collect()))
    assert got == sorted(map(tuple, left.join(right, "key", "left").select("id", "key", "v").collect()))


def test_take_bounded(spark):
    assert len(scale.take_bounded(spark.range(5), 5)) == 5
    assert scale.take_bounded(spark.range(6), 5) is None
