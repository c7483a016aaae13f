from millwright.__main__ import main
from millwright.operators import trees
from millwright.schema import FEATURES, SENSORS, TARGET
from millwright.sources.readings import write_csv


def test_prepare_train_score(spark, folder, monkeypatch):
    span = ", ".join(
        f"{s.low!r} + ({s.high!r} - {s.low!r}) * (id * {7 + i} % 101) / 100 as {s.name}"
        for i, s in enumerate(SENSORS)
    )
    rows = spark.range(400).selectExpr(*span.split(", "), f"cast(id * 7 % 101 > 50 as int) {TARGET}")
    write_csv(rows, f"{folder}/first")  # a folder of CSV files
    report = main(["prepare", "--store", f"{folder}/store", "--mode", "resplit", "--publish",
                   "--create", f"{folder}/first", "--export", f"{folder}/csv"])
    assert spark.read.option("header", True).csv(f"{folder}/csv").count() == 400
    assert report["published"] == 0 and sum(r["rows"] for r in report["rows"]) == 400
    registry = f"{folder}/models"
    monkeypatch.setattr("millwright.__main__.train_gbt",
                        lambda df, f, y: trees.train_gbt(df, f, y, n_trees=2))
    report = main(["train", "--store", f"{folder}/store", "--registry", registry,
                   "--data-updated", "--save", f"{folder}/model"])
    assert report["version"] == 0 and report["reason"] == "forced without comparison"
    rows.select(*FEATURES).write.parquet(f"{folder}/today")
    main(["score", "--registry", registry, "--input", f"{folder}/today", "--output", f"{folder}/scored"])
    scored = spark.read.parquet(f"{folder}/scored")
    assert scored.count() == 400 and scored.where("prediction is null").isEmpty()
    write_csv(rows.select(*FEATURES), f"{folder}/arriving")
    main(["score", "--stream", "--registry", registry, "--input", f"{folder}/arriving", "--output", f"{folder}/streamed"])
    assert spark.read.parquet(f"{folder}/streamed").count() == 400
    write_csv(rows.limit(0).selectExpr("cast(1 as bigint) reading_id", "*"), f"{folder}/inbox")
    report = main(["prepare", "--store", f"{folder}/store", "--mode", "merge", "--inbox", f"{folder}/inbox",
                   "--inbox-columns", "reading_id bigint", "--dedupe", "--max-files", "5"])
    assert not report["merged"] and report["rejected"] == 0
    assert main(["vacuum", "--store", f"{folder}/store", "--keep", "1"])["deleted"] >= 0
