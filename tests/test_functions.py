"""Worked cases of the column functions."""

from pyspark.sql import functions as F

from spanlake.functions import codec, flags


def one(spark, column, rows=((1,),), schema="x bigint"):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(column).collect()]


def test_node_packing(spark):
    assert one(spark, codec.pack_node(F.lit(3), F.lit(100), F.lit(1))) == [-1610612836]
    node = F.lit(-1610612836).cast("bigint")
    assert one(spark, F.array(codec.node_chrom(node), codec.node_pos(node), codec.node_strand(node), codec.flip_node(node))) == [[3, 100, 1, 1610612836]]


def test_codec_v1(spark):
    assert one(spark, codec.codec_v1(F.col("x")), [(63,), (64,), (128,), (192,), (255,)]) == [63, 64, 192, 448, 952]


def test_correction5_and_sizes(spark):
    assert one(spark, codec.correction5(F.lit(6), F.lit(1), F.lit(False))) == [4]
    assert one(spark, codec.correction5(F.lit(6), F.lit(3), F.lit(True))) == [0]
    assert one(spark, F.array(*codec.allowed_sizes(F.lit(4500), F.lit(0.15)))) == [[3913, 7826]]


def test_cascades(spark):
    f = flags.alignment_failure(F.lit(40), F.lit(0.2), F.lit(True), F.lit(10), F.lit(1), 50, 0.1, 100, 20)
    assert one(spark, f) == [1]
    flag = F.lit(16).bitwiseOR(flags.stem_site_failure(F.lit(-1), F.lit(-1), F.lit(1), F.lit(99), 5))
    assert one(spark, flag) == [112]
    assert one(spark, flags.is_chimeric(F.lit(112))) == [True]
    assert one(spark, flags.is_pre_chimeric(F.lit(112))) == [False]


def test_list_filters(spark):
    a = F.array(F.lit(0), F.lit(4))
    assert one(spark, F.array(*(flags.list_filter(a, 4, h) for h in ("any_pass", "all_pass", "any_fail", "all_fail")))) == [[True, False, True, True and False]]
    b = F.array(F.lit(4))
    assert one(spark, F.array(*(flags.list_filter(b, 12, h) for h in ("any_pass", "any_fail")))) == [[False, False]]


def test_labels(spark):
    assert one(spark, flags.coverage_label(F.lit(2), F.lit(3))) == [">=3 instances"]
    assert one(spark, flags.junction_class(F.lit(False), F.lit(1), F.lit(8), F.lit(0))) == ["artifact"]
    assert one(spark, flags.target_class(F.lit("A"), F.lit("T"))) == ["TA"]


def test_list_strings(spark):
    for encode in (codec.to_flanked, codec.to_terminated):
        assert one(spark, codec.from_list_string(encode(F.array(F.lit(5), F.lit(7))), "bigint")) == [[5, 7]]
        assert one(spark, codec.from_list_string(encode(F.array().cast("array<int>")), "bigint")) == [[]]


def test_reverse_complement_is_an_involution(spark):
    rows = [("ACGTN",), ("",), ("GGGA",), (None,)]
    assert one(spark, codec.reverse_complement(codec.reverse_complement(F.col("s"))), rows, "s string") == ["ACGTN", "", "GGGA", None]


def test_low_quality_windows(spark):
    q = F.array(*(F.lit(v) for v in [30] * 10 + [2] * 5 + [30] * 10))
    assert one(spark, flags.low_window(q, 5, 20, F.lit(25), 10)) == [True]
    assert one(spark, flags.low_window(q, 5, 20, F.lit(5), 10)) == [False]
    assert one(spark, flags.low_median(F.array(F.lit(1), F.lit(9)), 1, 9, F.lit(2))) == [False]


def test_traversal_modes(spark):
    same = (F.lit(1), F.lit(0), F.lit(1), F.lit(0))
    assert one(spark, flags.traversal_fails(*same, F.lit(-5), F.lit(3), 100, "wrap")) == [False]
    assert one(spark, flags.traversal_fails(*same, F.lit(-5), F.lit(3), 100, "signed")) == [True]


def test_query_on_reference(spark):
    f = codec.query_on_reference(F.lit("2S3M1I2M2D1M1S"), F.lit("NNACGTCATX"))
    assert one(spark, f) == ["AC+CA--T"]
