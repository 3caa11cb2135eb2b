"""Cleaning is row-wise, so the same function serves a stream of arriving files."""

from pricelens.plans.cleaning import clean_listings


def test_clean_listings_accepts_a_stream(spark, tmp_path):
    source, sink = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.csv").write_text('id,price,last_review\n1,"$1,200",2024-01-05\nx,5,\n')
    (source / "b.csv").write_text("id,price,last_review\n2,Private room,\n3,7,01/05/2024\n")
    raw = (
        spark.readStream.schema("id string, price string, last_review string")
        .option("header", True)
        .csv(str(source))
    )
    query = (
        clean_listings(raw)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(sink))
    )
    assert query.awaitTermination(120)
    got = {r.id: r.price for r in spark.read.parquet(str(sink)).collect()}
    assert got == {"1": 1200.0, "3": 7.0}
