import random

import corpus_pipeline
from tests.llm.cases import near, odd_rows, prose


def test_stages_catch_planted_cases_and_keep_clean_ones(spark, tmp_dir):
    rng = random.Random(22)
    item = prose(rng, 40)
    shared = prose(rng, 30)
    rows = [(i, t) for i, t in odd_rows(300)]
    labels = []
    for i in range(1000, 1500):
        words = prose(rng, 60).split()
        if i % 5 == 0:
            words.insert(rng.randrange(60), rng.choice(["scumbag", "moronic"]))
        labels.append((i, int(i % 5 == 0)))
        rows.append((i, " ".join(words)))
    base = prose(rng, 120)
    rows += [(2000, base), (2001, base), (2002, near(base, rng, 0.004)), (2003, prose(rng, 30) + " " + item + " " + prose(rng, 60))]
    rows += [(2010 + k, f"{prose(rng, 50)}\n{shared}\n{prose(rng, 20)}") for k in range(4)]
    rows += [(2020, prose(rng, 50) + " scumbag " + prose(rng, 10))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmp_dir)
        out.write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        if name != "pack":
            assert docs.columns == columns
            seen[name] = {r.doc_id: r.text for r in docs.collect()}
    clean = {i for i, y in labels if not y}
    assert all(clean <= set(s) for s in seen.values())
    assert not {i for i, y in labels if y} & set(seen["toxicity"]) and 2020 not in seen["toxicity"]
    assert seen["line_dedup"].keys() == seen["toxicity"].keys()
    assert [shared in seen["line_dedup"][2010 + k] for k in range(4)] == [False, False, False, True]
    assert {2000, 2001, 2002} & set(seen["jaccard_join"]) == {2000}
    assert item in seen["jaccard_join"][2003] and item not in seen["decontaminate"][2003]
    assert {r.doc_id for r in docs.collect()} == set(seen["decontaminate"])
    assert dict(corpus_pipeline.STAGES).keys() == {"toxicity", "line_dedup", "jaccard_join", "decontaminate", "pack"}


def test_empty_tables_and_the_written_sequences(spark, tmp_dir):
    tables = {"documents": "doc_id long, text string, lang string, source string, n_chars long",
              "labels": "doc_id long, toxic int", "benchmark": "item_id long, text string"}
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_dir}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_dir}/none", f"{tmp_dir}/out").count() == 0
    assert corpus_pipeline.write_sequences(spark, f"{tmp_dir}/out").count() == 0

    rng = random.Random(5)
    same = prose(rng, 80)
    rows = [(1, same), (1, same), (2, same), (3, None), (3, None), (None, prose(rng, 40)), (4, ""), (5, prose(rng, 3000))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], tables["documents"]) \
        .write.parquet(f"{tmp_dir}/some/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.createDataFrame([], tables[name]).write.parquet(f"{tmp_dir}/some/{name}.parquet")
    corpus_pipeline.run(spark, f"{tmp_dir}/some", f"{tmp_dir}/some/out")
    cleaned = spark.read.parquet(f"{tmp_dir}/some/out/{corpus_pipeline.CLEANED}")
    got = [r.doc_id for r in cleaned.select("doc_id").collect()]
    assert sorted(i for i in got if i is not None) == [1, 3, 4, 5] and got.count(None) == 1
    pieces = corpus_pipeline.write_sequences(spark, f"{tmp_dir}/some/out").collect()
    assert all(len(r.ids) == r.length for r in pieces) and len([r for r in pieces if r.doc_id == 5]) > 1
    for seq in {r.sequence_id for r in pieces}:
        at = 0
        for r in sorted((r for r in pieces if r.sequence_id == seq), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
