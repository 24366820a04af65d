from pistespark.streaming import features as st


def test_nearby_stream(spark, tmp_path):
    ddl = "id long, ts timestamp, lat double, lon double"
    src = str(tmp_path / "in")
    spark.sql("SELECT id, timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,id) ts, 45.0D + id*0.01D lat, 7.0D lon FROM range(6)").write.parquet(src)
    areas = spark.createDataFrame([(1, 45.0, 7.0)], "area_id int, area_lat double, area_lon double")
    pairs = st.nearby_stream(st.feature_stream(spark, src, ddl), areas, 2500.0)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):  # the second run finds nothing new
        st.to_parquet(pairs, out, check).awaitTermination()
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2]
    q = st.counts_by_area(pairs).writeStream.format("memory").queryName("by_area").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r["features"] for r in spark.sql("SELECT * FROM by_area").collect()) == 3
