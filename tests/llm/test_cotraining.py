"""Bounds of the samples that quality is learned from."""

from shelfwright.llm import cotraining


def test_samples_hold_one_row_per_id(spark, monkeypatch):
    rows = [(i, f"text {i}", "s", "en") for i in range(40)]
    rows += [(i, f"copy {n}", "s", "en") for i in range(0, 40, 2) for n in range(25)] + [(None, "no id", "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, i % 4 < 2, 0) for i in range(20)], "doc_id long, quality boolean, toxic int")
    labels = labels.selectExpr("doc_id", "cast(quality AS int) AS quality", "toxic")
    sampled, sizes = cotraining._sampled, []

    def count(rows, answers):
        found = sampled(rows, answers)
        sizes.append(len(found[0]))
        return found

    monkeypatch.setattr(cotraining, "_sampled", count)
    cotraining.fit(docs, labels)
    cotraining.fit(docs, labels, labelled_rows=7, pool_rows=5)
    assert sizes == [20, 20, 7, 5]
