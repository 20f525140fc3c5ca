from pyspark.sql import functions as F

from ledgerlake.functions.scalar import long_to_lsn, lsn_to_long, ratio_pct, row_text, size_pretty


def test_size_pretty_goldens(spark):
    # values shown by the reference's size formatter
    cases = {8192: "8192 bytes", 0: "0 bytes", 40960: "40 kB", 68272128: "65 MB", 68329472: "65 MB",
             40888896: "39 MB", 921583616: "879 MB", 84378504: "80 MB", 50661176: "48 MB", 8472: "8472 bytes",
             426164224: "406 MB", 5 * 2 ** 40: "5120 GB", 20 * 2 ** 40: "20 TB", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "b bigint")
    got = {r[0]: r[1] for r in df.select("b", size_pretty("b")).collect()}
    assert got == cases


def test_lsn_roundtrip_and_difference(spark):
    df = spark.createDataFrame([("0/85827258", "0/807AEED0")], "a string, b string")
    r = df.select((lsn_to_long("a") - lsn_to_long("b")).alias("d"), long_to_lsn(lsn_to_long("a")).alias("t")).first()
    assert r.d == 84378504
    assert r.t == "0/85827258"


def test_ratio_pct_integer_division_first(spark):
    df = spark.createDataFrame([(4999821, 1000001)], "dead bigint, live bigint")
    assert df.select(ratio_pct("dead", "live")).first()[0] == 499.0


def test_row_text_quotes_like_record_output(spark):
    df = spark.createDataFrame([(1, "plain", None, "a b", "x,y", 'q"t', "")], "a int, b string, c string, "
                               "d string, e string, f string, g string")
    got = df.select(row_text(*df.columns)).first()[0]
    assert got == '(1,plain,,"a b","x,y","q""t","")'


def test_text_length_goldens_hold_for_any_32_char_text(spark):
    from ledgerlake.operators.relational import joined_length
    from ledgerlake.sources.tables import synth_rows
    rows = synth_rows(spark, 1, 10 ** 6)
    # length of id || text joined with commas = digits + 32e6 + (1e6 - 1)
    assert joined_length(rows, F.concat(F.col("id").cast("string"), F.col("random_text"))).first()[0] == 38888895
    total = rows.agg(F.sum(F.length(row_text("id", "random_text")))).first()[0]
    assert total == 40888896
