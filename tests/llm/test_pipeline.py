"""The pipeline, its stages on odd tables, and the guard of the entry file."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from panelspark.llm import language
from panelspark.llm.near_dedup import shingles, text_words
from tests.llm.test_decontamination import brute as contaminated

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __key int, node string"


def write(spark, folder, rows):
    df = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x") for r in rows], SCHEMA)
    df.write.parquet(f"{folder}/documents.parquet")
    tests = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, None)], "item_id long, text string")
    tests.write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def spoken(rows, labels):
    """(id, text) of the texts that plain kernel ridge regression gives a score to stand on.

    All texts are landmarks here; the operator's landmarks are a sample, so that scores near
    the limit would differ. None of the documents is near it.
    """
    texts = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    marks = {}
    for i, t in texts:
        row = np.zeros(language.SLOTS, np.uint8)
        language.mark(row, t.lower().encode())
        marks[i] = np.packbits(row)
    learned = [i for i, _ in texts if crc32(str(i).encode()) % 4 != 2 and labels[i]]
    model = language.solve([labels[i] for i in learned], np.array([marks[i] for i in learned]), 10**6)
    scores = model.scores([t.lower().encode() for _, t in texts], *model.prepared())
    return [r for r, s in zip(texts, scores) if (s.max() + 1) / 2 >= language.LEAST_SCORE]


def kept_by_hand(rows, tests, labels):
    """The same pipeline in plain Python; rows are (id, text), ids distinct."""
    rows = spoken(rows, labels)
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = sorted((i, t) for t, i in last.items())
    sets = {i: shingles(text_words(t.encode())) for i, t in rows}
    part = {i: i for i, _ in rows}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for x, (a, _) in enumerate(rows):
        for b, _ in rows[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                part[high] = low
    rows = [(i, t) for i, t in rows if root(i) == i]
    return [(i, t) for i, t in rows if not contaminated(t, tests)[1]]


def digests(rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = set()
    for i, t in rows:
        ids = [1, *lib.encode(t), 2]
        out.add((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(lib.decode(ids).encode()).hexdigest()))
    return out


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    tests = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = kept_by_hand([(r["doc_id"], r["text"]) for r in docs], tests, {r["doc_id"]: r["lang"] for r in docs})
    assert 0 < len(want) < len(docs)
    assert set(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == digests(want)


def test_stages_on_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(999)}" for _ in range(20_000))
    near = [f"n{i}" for i in range(100)]
    rows = [
        (1, None, "en", "s"), (2, "", "en", "s"), (3, "12 34", "en", "s"), (4, long, None, None),
        (5, "same text here", "en", "s"), (6, "same text here", "de", "t"), (7, "x A B C D E F G H I J y", "en", "s"),
        (8, " ".join(near), "fr", "s"), (9, " ".join([*near[:-1], "other"]), "fr", "s"),
        (None, "lost and found", "en", "s"), (10, "clean one", "en", "s"), (10, "clean one", "en", "s"),
    ]
    folder = str(tmp_path / "t")
    docs = write(spark, folder, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "encode":
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert sorted(map(repr, (r["doc_id"] for r in docs.collect()))) == sorted(map(repr, [4, 6, 8, None, 10]))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_an_empty_table(spark, tmp_path, name, stage):
    folder = str(tmp_path / "t")
    docs = write(spark, folder, [(1, "a", "en", "s")]).limit(0)
    assert stage(spark, docs, folder).count() == 0


def test_entry_lists_all_text_queries():
    from __spark_entry__ import oracle_sql, queries

    names = queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(oracle_sql()) <= set(names)


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without the text folders still offers the other queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parents[2]
    for part in ("panelspark", "driver_queries"):
        shutil.copytree(repo / part, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); print(len(n), any(x.startswith('op') for x in n), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert said.returncode == 0, said.stderr
    count, text, sql = said.stdout.split()
    assert int(count) >= 140 and text == "False" and int(sql) >= 140
