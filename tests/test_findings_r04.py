"""Cases of the findings of round 4."""

from pyspark.sql import functions as F


def test_f1_a_pack_may_hold_no_street_inside_its_cells(spark, monkeypatch):
    from wayweave.operators import routes

    monkeypatch.setattr(routes, "PACK", 1)  # node 8 is a cell without inner streets, in most wards alone in its pack
    wards = spark.range(40).select(F.concat(F.lit("w"), "id").alias("ward"), F.explode(F.expr("sequence(0L, 7L)")).alias("u"))
    edges = wards.select("ward", F.col("u").alias("edge_id"), "u", (F.col("u") + 1).alias("v"), F.lit(2.0).alias("length_m"))
    trips = edges.select("ward").distinct().select("ward", F.lit(3).alias("trip_id"), F.lit(8).alias("origin"), F.lit(1).alias("goal"))
    got = routes.shortest_paths(edges, trips, "length_m", lambda node: F.floor(node / 4).cast("string")).collect()
    assert len(got) == 40 and all(r.cost == 14.0 and r.path == list(range(7, 0, -1)) for r in got)


def test_f3_java_compiles_the_step_that_sums_windings(spark):
    import random

    from wayweave.operators import overlay

    rng = random.Random(6)
    sides, want = [], {}
    places = [(g, k, rng.randint(0, 60) + 0.25, rng.randint(0, 60) + 0.375) for g in ("g", "h") for k in range(60)]
    for g in ("g", "h"):
        for layer in ("own", "less"):
            for _ in range(4):
                ring = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(6)] + [(5, 5), (40, 5), (40, 31), (5, 31)]
                sides += [(g, layer, *p, *q, 1) for p, q in zip(ring, ring[1:] + ring[:1], strict=True) if p != q]
    for g, k, x, y in places:
        for h, layer, ax, ay, bx, by, _ in sides:
            if g == h and (ay <= y) != (by <= y) and ax + (bx - ax) * (y - ay) / (by - ay) > x:
                want[g, k, layer] = want.get((g, k, layer), 0) + (1 if by > ay else -1)
    edges = spark.createDataFrame(sides, "grp string, layer string, ax long, ay long, bx long, by long, n long")
    points = spark.createDataFrame(places, "grp string, id long, x double, y double")
    got = {(r.grp, r.id, r.layer): r.w for r in overlay.winding_at(points, edges, 8.0).collect()}
    assert got == {k: w for k, w in want.items() if w}

    ids = edges.select("grp", F.struct(F.struct("ax", "ay").alias("a"), F.struct("bx", "by").alias("b")).alias("id"), F.col("ax") + 0.25, F.col("ay") + 0.375).toDF("grp", "id", "x", "y")
    unset = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = overlay._turns(ids, edges, 8.0)._jdf.queryExecution().executedPlan()
    finally:
        for k, v in unset.items():
            spark.conf.set(k, v)
    parts = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.length())) < 8000  # Java interprets longer methods
