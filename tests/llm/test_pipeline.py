from __future__ import annotations

import corpus_pipeline
from trackloom.llm.common import materialize


def test_stages_in_a_row(spark, data, docs, odd):
    for source in (docs, odd, odd.limit(0)):
        now, counts, first = source, [source.count()], source.columns
        for name, stage in corpus_pipeline.STAGES:
            now = materialize(stage(spark, now, data), f"test-{name}")
            counts.append(now.count())
            if name != "bpe":
                assert now.columns == first
        assert counts == sorted(counts, reverse=True)
        assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in now.collect())


def test_names_and_run(spark, data):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]
    out = corpus_pipeline.run(spark, data)
    assert out.count() > 0 and corpus_pipeline.queries()["pipeline"] is corpus_pipeline.run


def test_run_against_plain_stages(spark, data, docs, texts):
    """Every document's way through the stages, with plain versions of their decisions."""
    from tests.llm.test_bpe import ids_of
    from tests.llm.test_decontamination import brute
    from trackloom.llm import neardup, pii, toxicity

    model = toxicity.train_on(docs, spark.read.parquet(f"{data}/labels.parquet"))
    words = {d: toxicity.words_of(t) for d, t in texts.items()}
    kept = {d for d, w in words.items() if model.score(model.logits([toxicity.ids_of(w)])[0], toxicity.language_of(w)) < 0.5}

    shingles = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d in kept for w in [neardup.words_of(texts[d])]}
    parent = {d: d for d in kept}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in kept:
        for b in kept:
            both = len(shingles[a] & shingles[b])
            if a < b and both >= 0.8 * (len(shingles[a]) + len(shingles[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    kept = {d for d in kept if root(d) == d}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    kept = {r[0] for r in brute([(d, texts[d]) for d in sorted(kept)], items) if not r[-1]}
    field = pii.train_on(docs.where(docs["doc_id"].isin(sorted(kept))))
    want = {d: ids_of(pii.masked(texts[d], pii.find(texts[d], field)[1])) for d in kept}
    assert {r["doc_id"]: r["token_ids"] for r in corpus_pipeline.run(spark, data).collect()} == want
