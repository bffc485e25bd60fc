import hashlib
import random
from collections import Counter

import duckdb
import pandas as pd
import sentencepiece
from test_linedup import brute as brute_lines
from test_simhash import brute_keep

import corpus_pipeline
from folioframe.llm import linedup, mixing, pieces, toxicity


def rows():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(500)]
    line = lambda n: " ".join(rng.choices(vocab, k=n))
    shared = line(30)
    out = []
    for i in range(140):
        lines = [line(rng.choice([6, 25])) for _ in range(rng.randrange(1, 7))]
        if i % 5 == 0:
            lines.insert(0, shared)
        if i % 4 == 0:
            lines[-1] += " grubby vilest rotten grubby"
        out.append((i, "\n".join(lines)))
    out += [(200 + i, out[i][1]) for i in range(20)]
    out += [(300 + i, out[i][1].replace("w1", "w2", 1)) for i in range(1, 20)]
    out += [(400, None), (401, ""), (402, "two words"), (403, "two words"), (None, "no id here")]
    return [(d, t, "en", rng.choice(["a", "b", "c", None]), len(t or "")) for d, t in out]


def test_stages_against_plain_python(spark, tmp_path):
    data = rows()
    sf = str(tmp_path)
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(d, 1, int("grubby" in (t or ""))) for d, t, *_ in data if d is not None], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stage = [f for _, f in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None

    def written(df, name):
        df.write.parquet(f"{sf}/{name}")
        return spark.read.parquet(f"{sf}/{name}")

    bag = lambda df: Counter((r.doc_id, r.text, r.source) for r in df.collect())

    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    one = toxicity.scorer(model)
    a = written(stage[0](spark, docs, sf), "a")
    plain = [r for r in data if one(r[1] or "") < 0.5]
    assert a.columns == docs.columns and bag(a) == Counter((d, t, s) for d, t, _, s, _ in plain)
    assert 0 < len(data) - len(plain) and not any("grubby" in (t or "") for _, t, *_ in plain)

    b = written(stage[1](spark, a, sf), "b")
    texts = brute_lines([(d, t) for d, t, *_ in plain], linedup.MIN_WORDS, linedup.RARE)
    plain = [(d, t, r[3]) for (d, t), r in zip(texts, plain) if t == r[1] or (t or "").strip()]
    assert bag(b) == Counter(plain)

    c = written(stage[2](spark, b, sf), "c")
    plain = brute_keep(plain)
    assert 10 < len(texts) - len(plain)
    assert bag(c) == Counter(plain)

    d = written(stage[3](spark, c, sf), "d")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(plain, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    taken = {(None if pd.isna(r.doc_id) else int(r.doc_id)): r.taken for r in con.sql(mixing.SQL).df().itertuples()}
    got = Counter()
    for r in d.collect():
        got[r.doc_id] += len((r.text or "").split())
    assert {k: v for k, v in taken.items() if v} == dict(got) and d.columns == docs.columns

    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    e = stage[4](spark, d, sf).select(columns).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    ids = [(r.doc_id, lib.encode(r.text or "")) for r in d.collect()]
    want = Counter((k, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(lib.decode(x).encode()).hexdigest()) for k, x in ids)
    assert Counter(map(tuple, e)) == want
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).select(columns).collect())) == want


def test_empty_input(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
