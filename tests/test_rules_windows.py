from pyspark.sql import functions as F

from rivulet.operators import rules, windows


def test_lag_and_row_number_skew_safe_match_window(spark):
    from pyspark.sql.window import Window
    # key 1 is hot (spans every range partition); NULL keys form their own group
    rows = [(None if i % 11 == 0 else 1 if i % 3 else i % 7, i, None if i % 13 == 0 else f"s{i % 5}")
            for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, t long, v string").repartition(8)
    w = Window.partitionBy("k").orderBy("t")
    want = {(r["k"], r["t"]): (r["p"], r["n"]) for r in
            df.select("k", "t", F.lag("v").over(w).alias("p"), F.row_number().over(w).alias("n")).collect()}
    lag = windows.lag_skew_safe(df, "k", ["t"], "v", "p")
    rn = windows.row_number_skew_safe(df, "k", ["t"], "n")
    got = {(r["k"], r["t"]): r["p"] for r in lag.collect()}
    got_n = {(r["k"], r["t"]): r["n"] for r in rn.collect()}
    assert {k: v[0] for k, v in want.items()} == got
    assert {k: v[1] for k, v in want.items()} == got_n


def test_insert_if_absent_null_keys_and_first_wins(spark):
    t = spark.createDataFrame([(1, "a@x"), (2, None)], "id long, email string")
    new = spark.createDataFrame([(3, "a@x"), (4, "b@x"), (5, "b@x"), (6, None), (7, None)],
                                "id long, email string")
    got = sorted(r["id"] for r in rules.insert_if_absent(t, new, "email").collect())
    assert got == [1, 2, 4, 6, 7]


def test_update_by_key_touches(spark):
    import datetime as dt
    t = spark.createDataFrame([(1, "a", dt.datetime(2000, 1, 1)), (2, "b", dt.datetime(2000, 1, 1))],
                              "id long, email string, updated_at timestamp")
    ch = spark.createDataFrame([(2, "z")], "id long, email string")
    got = {r["id"]: (r["email"], r["updated_at"]) for r in
           rules.update_by_key(t, ch, "id", dt.date(2001, 8, 1)).collect()}
    assert got[1] == ("a", dt.datetime(2000, 1, 1))
    assert got[2][0] == "z" and got[2][1].date() == dt.date(2001, 8, 1)


def test_delete_cascade(spark):
    p = spark.createDataFrame([(1,), (2,)], "id long")
    c = spark.createDataFrame([(10, 1), (11, 2), (12, 2)], "id long, pedido_id long")
    newp, newc = rules.delete_cascade(p, c, spark.createDataFrame([(2,)], "id long"))
    assert [r["id"] for r in newp.collect()] == [1]
    assert [r["id"] for r in newc.collect()] == [10]
