"""Cleaning, derived columns, profiles and splits on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from flowlens.functions import columns as fx
from flowlens.operators import explore, profile, sampling, sequence, split
from flowlens.operators.clean import clean_flows, drop_leaky, lower_names, with_endpoints
from flowlens.operators.encode import category_codes, encode
from flowlens.schema import LEAKY_COLUMNS, flow_schema, schema_from_features


def values(df, column):
    return [r[column] for r in df.collect()]


def one(spark, ddl, *row):
    return spark.createDataFrame([row], ddl)


def test_attack_name(spark):
    raw = [None, "", "  ", " Fuzzers ", "Backdoors", "Backdoor", "Normal"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, a string").orderBy("i")
    assert values(df.select("i", fx.attack_name("a").alias("a")).orderBy("i"), "a") == [
        "Normal", "Normal", "Normal", "Fuzzers", "Backdoor", "Backdoor", "Normal"]
    assert values(df.select("i", fx.attack_name("a", False).alias("a")).orderBy("i"), "a") == [
        None, "", "", "Fuzzers", "Backdoor", "Backdoor", "Normal"]


def test_clean_flows(spark):
    df = spark.createDataFrame(
        [("1.1.1.1", None, "-", None, " 12 ", float("nan"), None, None, 5)],
        "srcip string, proto string, service string, state string, sbytes string, dload double,"
        " spkts int, attack_cat string, stime int")
    row = clean_flows(df).first().asDict()
    assert row == {"proto": "Unknown", "service": "-", "state": "Unknown", "sbytes": 12.0, "dload": 0.0,
                   "spkts": 0, "attack_cat": "Normal"}


def test_text_to_numbers(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([" ", "0x20", "1e3", "-", "7"])], "i int, s string")
    got = df.orderBy("i").select(fx.to_double("s").alias("d"), fx.to_int("s").alias("n")).collect()
    assert [r.d for r in got] == [0.0, 0.0, 1000.0, 0.0, 7.0]
    assert [got[0].n, got[1].n, got[3].n, got[4].n] == [None, None, None, 7]


def test_bytes_ratio(spark):
    df = spark.createDataFrame([(0, 5.0, 0.0), (1, 5.0, None), (2, 5.0, 2.0), (3, None, 2.0)],
                               "i int, sbytes double, dbytes double").orderBy("i")
    assert values(df.select("i", fx.bytes_ratio().alias("r")).orderBy("i"), "r") == [0.0, None, 2.5, None]


@pytest.mark.parametrize("missing", range(4))
def test_threat_score_of_missing_input(spark, missing):
    row = [10.0, 4.0, 6.0, 2.0]
    row[missing] = None
    df = one(spark, "sbytes double, avg_sbytes_proto double, sload double, avg_sload_proto double", *row)
    assert values(df.select(fx.threat_score().alias("t")), "t") == [0.0]


def test_threat_score(spark):
    df = one(spark, "sbytes double, avg_sbytes_proto double, sload double, avg_sload_proto double", 10.0, 4.0, 6.0, 2.0)
    assert values(df.select(fx.threat_score().alias("t")), "t")[0] == pytest.approx(0.5 * 6 / 5 + 0.5 * 4 / 3)
    zero = one(spark, "sbytes double, avg_sbytes_proto double, sload double, avg_sload_proto double", 3.0, 0.0, 5.0, 0.0)
    assert values(zero.select(fx.threat_score().alias("t")), "t") == [4.0]


def test_unseen_keys_become_zero(spark):
    ddl = "proto string, state string, dur double, sbytes double, dbytes double, sload double, spkts int, dpkts int"
    train = spark.createDataFrame([("tcp", "FIN", 1.0, 10.0, 0.0, 3.0, 1, 2), ("tcp", "CON", 3.0, 20.0, 4.0, 5.0, 3, 4)], ddl)
    test = spark.createDataFrame([("udp", "INT", 1.0, 10.0, 5.0, 3.0, 1, 2), ("tcp", "FIN", 1.0, 15.0, 5.0, 4.0, 1, 2)], ddl)
    got = {r.proto: r for r in profile.enrich(test, profile.fit_profile(train)).collect()}
    assert got["udp"].threat_score == 0.0 and got["udp"].avg_dur_proto == 0.0 and got["udp"].avg_dur_state == 0.0
    assert got["tcp"].avg_dur_proto == 2.0 and got["tcp"].avg_dur_state == 1.0 and got["tcp"].threat_score == 0.0
    assert got["udp"].bytes_ratio == 2.0


def test_leaky_names_and_endpoints(spark):
    df = one(spark, "` SrcIP ` string, DSTIP string, sttl int", "a", None, 3)
    low = lower_names(df)
    assert low.columns == ["srcip", "dstip", "sttl"]
    assert not set(LEAKY_COLUMNS) & set(drop_leaky(low).columns)
    assert with_endpoints(low).count() == 0


def test_schema_from_features(spark):
    rows = [(" Srcip ", "nominal"), ("Dur", "Float"), ("sttl", " integer"), ("Label", "binary"), ("Stime", "Timestamp")]
    schema = schema_from_features(spark.createDataFrame(rows, "Name string, `Type ` string"))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("srcip", "string"), ("dur", "double"), ("sttl", "double"), ("label", "double"), ("stime", "double")]
    assert len(flow_schema()) == 49


# ---- split --------------------------------------------------------------

@pytest.mark.parametrize("times,fraction,expected", [
    ([5, 1, 4, 2, 3], 0.8, 4), ([7] * 10, 0.8, 7), ([1], 0.8, 1), ([None, 3, None], 0.5, 3),
    ([-10**12, 0, 10**15, 10**17], 0.5, 0), ([-3, -2, -1], 0.1, -3), ([1, 2, 3, 4], 1.0, 4),
])
def test_exact_quantile(spark, times, fraction, expected):
    df = spark.createDataFrame([(t,) for t in times], "stime long")
    assert split.exact_quantile(df, "stime", fraction) == expected


def test_split_leaves_untimed_rows_out(spark):
    df = spark.createDataFrame([(t,) for t in [1, 2, 2, 2, 3, None]], "stime int")
    parts = split.chronological_split(df, fraction=0.8, method="exact")
    assert parts.threshold == 2
    assert (parts.train.count(), parts.test.count()) == (4, 1)
    counts = split.split_counts(df, 2).first()
    assert (counts.n_rows, counts.n_train, counts.n_test, counts.n_untimed) == (6, 4, 1, 1)
    assert split.exact_quantile(df.filter("stime is null"), "stime", 0.8) is None


def test_approx_split_is_near_the_rank(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).cast("int").alias("stime"))
    parts = split.chronological_split(df)
    assert abs(parts.train.count() - 8000) <= 100
    with pytest.raises(ValueError):
        split.chronological_split(df, method="other")


# ---- sampling, codes ----------------------------------------------------

def test_class_weights_with_missing_class(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [(None,)] * 2, "attack_cat string")
    got = {r.attack_cat: r.class_weight for r in sampling.with_class_weights(df).distinct().collect()}
    assert got == {"a": pytest.approx(10 / 18), "b": pytest.approx(10 / 6), None: 1.0}


def test_undersample_is_exact(spark):
    sizes = {"big": 20_000, "mid": 501, "small": 3, None: 700}
    df = None
    for name, n in sizes.items():
        part = spark.range(n).select(F.lit(name).cast("string").alias("c"), F.lit(1).alias("same"))
        df = part if df is None else df.unionByName(part)
    got = {r.c: r["count"] for r in sampling.undersample(df, "c", cap=500).groupBy("c").count().collect()}
    assert got == {"big": 500, "mid": 500, "small": 3, None: 500}


def test_bernoulli_undersample_is_near_the_cap(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 100, "rare").otherwise("common").alias("c"))
    got = {r.c: r["count"] for r in sampling.undersample_bernoulli(df, "c", cap=2000).groupBy("c").count().collect()}
    assert got["rare"] == 100 and abs(got["common"] - 2000) < 250


def test_row_samples(spark):
    df = spark.range(10_000)
    assert abs(sampling.sample_rows(df).count() - 1000) < 200
    first, again = (set(values(sampling.sample_by_hash(df, ["id"]), "id")) for _ in range(2))
    assert first == again and abs(len(first) - 1000) < 200


def test_codes_and_unseen_values(spark):
    df = spark.createDataFrame([("tcp", "z"), ("arp", "y"), ("udp", None)], "proto string, service string")
    codes = category_codes(df, ["proto", "service"])
    assert {(r.column, r.value): r.code for r in codes.collect()} == {
        ("proto", "arp"): 0, ("proto", "tcp"): 1, ("proto", "udp"): 2, ("service", "y"): 0, ("service", "z"): 1}
    other = spark.createDataFrame([("igmp", "y"), (None, "z")], "proto string, service string")
    got = encode(other, codes, ["proto", "service"]).collect()
    assert {(r.proto, r.proto_code, r.service_code) for r in got} == {("igmp", -1, 0), (None, -1, 1)}


# ---- sequence -----------------------------------------------------------

def test_dense_index_has_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 10).alias("k"), "id")
    got = sequence.dense_index(df, ["k", "id"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_copies_are_spread_over_ranges(spark):
    """Equal rows do not end up in one range, and are still numbered without gaps."""
    df = spark.range(40_000, numPartitions=8).select(F.lit(7).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = sequence._range_sorted(df, [F.col("k")], unique=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    got = sequence.dense_index(df, ["k"], "n").agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert max(sizes) < 40_000 and sum(sizes) == 40_000
    assert tuple(got) == (1, 40_000, 40_000)


def test_running_sums(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("v"))
    got = sequence.running_sums(df, [F.desc("id")], {"upto": "v"}).collect()
    assert {r.id: r.upto for r in got} == {i: sum(j % 7 for j in range(i, 500)) for i in range(500)}


@pytest.mark.parametrize("block_rows", [3, 10, 100, 25_000])
def test_connection_counts_against_brute_force(spark, block_rows):
    rows = [(i, f"s{i * i % 5}" if i % 3 else "hub", f"d{i % 4}", str(i % 3), str(i % 2), "http" if i % 2 else None)
            for i in range(300)]
    df = spark.createDataFrame(rows, "t int, srcip string, dstip string, sport string, dsport string, service string")
    last = 10
    got = {r.t: r for r in sequence.connection_counts(df, ["t"], last=last, block_rows=block_rows).collect()}
    names = ["t", "srcip", "dstip", "sport", "dsport", "service"]
    assert len(got) == 300
    for i in range(300):
        for feature, keys in sequence.CONNECTION_COUNTS.items():
            at = [names.index(k) for k in keys]
            near = rows[max(0, i - last + 1): i + 1]
            assert got[i][feature] == sum(all(r[k] == rows[i][k] for k in at) for r in near), (i, feature)


def test_synthetic_timestamps(spark):
    got = sequence.synthetic_timestamps(spark.range(5), ["id"]).select("id", F.unix_seconds("timestamp").alias("s"))
    assert {r.id: r.s for r in got.collect()} == {i: 1421927415 + i for i in range(5)}


# ---- exploration --------------------------------------------------------

def test_ties_in_top_list_follow_the_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "srcip string")
    assert [tuple(r) for r in explore.top_talkers(df, 2).collect()] == [("c", 2), ("a", 1)]


def test_flags(spark):
    df = spark.createDataFrame([("a", "1", "a", "1"), ("a", "1", "a", "2"), (None, "1", "a", "1")],
                               "srcip string, sport string, dstip string, dsport string")
    assert values(df.select(fx.same_endpoint().alias("f")), "f") == [1, 0, 0]
