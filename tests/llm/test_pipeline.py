import pytest

import corpus_pipeline as P
from geoweave.llm.decontaminate import contaminated
from geoweave.llm.language import identify
from geoweave.llm.minhash import Banding, near_duplicates
from geoweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    names = [n for n, _ in P.STAGES]
    assert names == ["quality", "language", "near_copies", "benchmark_passages", "mixing"]
    ids = {r.doc_id for r in docs.collect()}
    before = docs
    for name, stage in P.STAGES[:-1]:
        stage(spark, before, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == docs.columns
        now = {r.doc_id for r in after.collect()}
        assert now <= ids and now
        gone = ids - now
        if name == "quality":
            known = [i for i in ids if i in labels]
            assert sum(labels[i] == 1 for i in known if i in now) >= 0.97 * sum(labels[i] == 1 for i in known)
            assert sum(labels[i] == 0 for i in known if i in gone) >= 0.85 * sum(labels[i] == 0 for i in known)
        elif name == "language":
            assert len(gone) <= 0.02 * len(ids)
            right = identify(after, keep=["doc_id", "lang"]).filter("lang <> lang_pred and score >= 0.75").count()
            assert right <= 2
        elif name == "near_copies":
            assert near_duplicates(after, banding=Banding(size=5, num=80, den=100)).filter("not kept").count() == 0
            keep = {r.doc_id for r in near_duplicates(before, banding=Banding(size=5, num=80, den=100)).filter("kept").collect()}
            assert now == keep
        else:
            hit = {r.doc_id for r in contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert gone == hit and gone
        ids, before = now, after
    mixed = P.mixing(spark, before, SF).collect()
    assert {r.doc_id for r in mixed} <= ids


def test_empty_and_odd_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, "the of and that with", None, None, None), (10**6, None, "en", "s", 0), (10**6 + 1, "", None, "s", 0), (10**6 + 2, "the of and that " * 50_000, "en", None, 7)],
        docs.schema,
    )
    for start in (docs.limit(0), docs.limit(300).union(odd)):
        before = start
        for k, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, before, SF)
            path = str(tmp_path / f"{'e' if start.schema is docs.schema else 'o'}{id(start)}{k}")
            out.write.parquet(path)
            before = spark.read.schema(out.schema).parquet(path)
        before.count()


def test_one_row_of_each_group_also_without_ids_of_its_own(spark):
    import random

    rng = random.Random(2)
    text = lambda: [rng.choice("abcdefghijklmnop") + rng.choice("aeiou") + rng.choice("klmnr") for _ in range(60)]
    bases = [text() for _ in range(12)]
    rows = []
    for i, base in enumerate(bases):
        for c in range(6):
            w = list(base)
            if c % 2:
                w[rng.randrange(60)] = "zzz"  # 46 of 66 or more of the shingles stay: above 0.8
            rows.append((rng.choice([None, 5, 6, 100 + 10 * i + c]), " ".join(w), "en", "s", c))
    rows += rows[:9] + [(None, None, "en", "s", 1), (None, None, "en", "s", 1), (77, "one row alone", "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    got = P.near_copies(spark, spark.createDataFrame(rows, schema), SF).collect()
    grams = lambda t: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    texts = sorted({t for _, t, *_ in rows if t and " " in t and t != "one row alone"})
    group = {t: t for t in texts}
    for x in texts:
        for y in texts:
            a, b = grams(x), grams(y)
            if 100 * len(a & b) >= 80 * len(a | b):
                old, new = group[y], group[x]
                group = {t: new if g == old else g for t, g in group.items()}
    kept = [group[r.text] for r in got if r.text in group]
    assert sorted(kept) == sorted(set(group.values()))
    assert sum(r.text is None for r in got) == 1 and sum(r.doc_id == 77 for r in got) == 1


def test_registered():
    assert [n for n in QUERIES] == [
        "op1_toxicity_grammar", "op2_html_blocks", "op3_language_kernel", "op4_source_mixing", "op5_decontamination",
        "op6_embedding_near_dup", "op7_quality_resampling", "op8_warc_zip", "op9_token_counts", "op10_minhash_near_dup",
        "op11_divergence_rows", "op12_phrase_streams", "op13_secret_trigrams", "pipeline",
    ]


@pytest.mark.parametrize("name", ["op8_warc_zip", "op6_embedding_near_dup"])
def test_oracle_on_small_tables(spark, name):
    import duckdb

    from geoweave.llm.queries import SQL

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    rel = con.sql(SQL[name])
    assert got.columns == rel.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rel.fetchall(), key=repr)
