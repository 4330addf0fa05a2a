"""The corpus pipeline on a small folder, and the SQL of the training-text queries against their operators."""

import hashlib
import os
import random

import duckdb
import pytest

pytest.importorskip("symbolweave.llm")

import public_tokenizers  # noqa: E402
import tokenizers  # noqa: E402

import corpus_pipeline  # noqa: E402
from symbolweave.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, note string"


def written(spark, folder, docs, labels):
    spark.createDataFrame(docs, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    clean = {i: "\n".join(say(14) for _ in range(5)) for i in range(40)}
    toxic = {i: clean[i - 100] + " vile slur vile\n" + say(9) + " vile slur" for i in range(100, 130)}
    for i in toxic:
        toxic[i] = "\n".join(say(14) + " vile slur" for _ in range(5))
    copies = {200: clean[0], 201: clean[1].replace("a", "a", 1)}
    near = {202: clean[2] + " end"}
    shared = {300: say(30) + "\n" + clean[3].split("\n")[0] + "\n" + say(30)}
    odd = [(400, None), (401, ""), (None, say(20)), (402, "one two"), (402, "one two")]
    rows = [(i, t, "en", f"s{(i or 0) % 3}", 1, "n") for i, t in [*clean.items(), *toxic.items(), *copies.items(), *near.items(), *shared.items(), *odd]]
    labels = [(i, 1, 0) for i in clean] + [(i, 0, 1) for i in toxic] + [(0, 1, 0), (None, 0, 1), (7, 0, None)]
    folder = written(spark, tmp_path, rows, labels)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "note"]
        kept.append(docs.collect())
    assert {r.doc_id for r in kept[0]} == {i for i, *_ in rows if i not in toxic}
    texts = {r.doc_id: r.text for r in kept[1]}
    assert len(kept[1]) == len(kept[0]) and texts[5] == clean[5] and texts[300].count("\n") == 1 and texts[200] == ""
    ids = {r.doc_id for r in kept[2]}
    assert set(clean) <= ids and 300 in ids and None in ids
    encoded = corpus_pipeline.run(spark, folder).collect()
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    digests = {hashlib.sha256(" ".join(map(str, library.encode(r.text or "", add_special_tokens=False).ids)).encode()).hexdigest() for r in kept[2]}
    assert {r.ids_sha256 for r in encoded} <= digests and {r.doc_id for r in encoded} <= ids and len(encoded) > len(ids)


def test_pipeline_of_nothing(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{table}')")
    stated = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in stated.description]
    found = queries.QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=key) == sorted(stated.fetchall(), key=key)
