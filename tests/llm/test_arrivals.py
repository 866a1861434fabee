"""Problem 3: the query takes its rows in several batches, and each later one is checked against what is stored."""

from pyspark.sql import functions as F

from feedmill.llm import history, queries

WORDS = "Компания готовит площадку под строительство школы объём выпуска цемента в области составил больше чем годом ранее сообщили в ведомстве номер".split()


def test_the_query_takes_several_batches(spark, rows, repairer, tmp_path, monkeypatch):
    texts = [" ".join([*WORDS, str(k % 4), *WORDS[::-1], str(k % 4), "конец" * (k % 3 + 1)]) + "." for k in range(12)]
    df = rows(*texts).withColumn("source", F.col("item_no").cast("string"))
    df = df.withColumn("url", F.when(F.col("item_no") == 11, F.lit("https://h.example/0")).otherwise(F.col("url")))
    df = df.withColumn("batch_no", F.when(F.col("item_no") > 0, F.col("item_no").cast("int")))
    df.write.parquet(f"{tmp_path}/unified.parquet")
    spark.createDataFrame([(1, "ru", " ".join(WORDS))], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sizes, add = [], history.History.add
    monkeypatch.setattr(history.History, "add", lambda self, arriving: (sizes.append(arriving.count()), add(self, arriving)))
    found = sorted(map(tuple, queries.p3_found(spark, str(tmp_path)).collect()))
    assert len(sizes) == 4 and all(sizes) and sum(sizes) == 12
    assert found and found == sorted(map(tuple, history.repeated_articles(df, repairer).collect()))
