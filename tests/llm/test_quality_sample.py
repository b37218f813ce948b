import random

from tagwise.llm import quality
from tests.llm import helpers as H


def test_repeated_ids_and_labels_do_not_fill_the_sample(spark, monkeypatch):
    rng = random.Random(3)
    texts = {i: H.words(rng, 20) for i in range(90)}
    kept = [r.id for r in spark.range(90).where(~quality.held_out(quality.F.col("id"))).collect()]
    docs = [(i, t, len(t)) for i, t in texts.items()] + [(kept[0], texts[kept[0]], 1)] * 300 + [(kept[1], H.words(rng, 9), 1) for _ in range(300)]
    labels = [(i, i % 2) for i in texts] + [(kept[2], kept[2] % 2)] * 300
    seen = []
    monkeypatch.setattr(quality, "fit_machine", lambda rows, y: seen.append(y.tolist()))
    df = spark.createDataFrame(docs, "doc_id long, text string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int")
    quality.fit(*df, sample_rows=1000)
    assert len(seen[0]) == len(kept) + 300  # every text of a labelled id once
    quality.fit(*df, sample_rows=20)
    assert seen[1].count(0) <= 20 and seen[1].count(1) <= 20 and len(seen[1]) > 20
    quality.fit(df[0].where("n_chars > 1").distinct(), df[1], sample_rows=20)
    assert seen[2].count(0) == seen[2].count(1) == 20  # repeated labels take no place of others
