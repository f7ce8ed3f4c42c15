"""Every stage of the pipeline against SQL or a plain version, on its own input; edge cases."""

import base64
import random

import duckdb
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_llm_ngram_join import plain_components

import corpus_pipeline
from panelspark.llm import sql

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, as folders of Parquet."""
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs, at = spark.read.parquet(f"{ROOT}/documents.parquet"), f"{ROOT}/documents.parquet"
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, ROOT).write.parquet(path)
        out.append((at, f"{path}/*.parquet"))
        docs, at = spark.read.parquet(path), f"{path}/*.parquet"
    return out


def table(path, query="SELECT * FROM documents"):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    return con.execute(query).fetchall()


def test_rejected_languages(stages):
    before, after = ({r[0]: r for r in table(p)} for p in stages[0])
    gone = set(before) - set(after)
    assert all(after[k] == before[k] for k in after)
    assert len(gone) <= 0.02 * len(before)
    assert all(len(before[k][1]) < 60 or not any(c.isalpha() for c in before[k][1]) for k in gone)
    assert not [k for k, r in before.items() if k in after and not any(c.isalpha() for c in r[1])]


def test_lines(stages):
    kept = {r[0]: r for r in table(stages[1][1])}
    before = {r[0]: r for r in table(stages[1][0])}
    digest = {r[0]: r[1] for r in table(stages[1][1], "SELECT doc_id, md5(text) FROM documents")}
    want = table(stages[1][0], sql.LINE_DEDUP)
    assert any(removed for _, _, removed, _ in want)
    for doc_id, lines, removed, md5 in want:
        if removed and removed == lines:
            assert doc_id not in kept
        else:
            assert digest[doc_id] == md5
            assert kept[doc_id][2:4] == before[doc_id][2:4] and kept[doc_id][4] == len(kept[doc_id][1])


def test_near_duplicates(stages):
    before = table(stages[2][0])
    component = plain_components([r[:2] for r in before])
    assert sorted(table(stages[2][1])) == sorted(r for r in before if component[r[0]] == r[0])


def plain_near_copies(rows, size=5, percent=80):
    """Links of all pairs, by sets of word tuples, and the smallest id each document reaches."""
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        width = min(size, len(words))
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()
    links = [(a, b) for a in sets for b in sets
             if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    reach = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            reach[a] = reach[b] = min(reach[a], reach[b])
    return links, reach


def test_near_duplicates_between_the_thresholds(spark):
    """Copies that only five words and 0.8 link go, those just below 0.8 stay."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for i in range(20):
        base = text(200)
        rows.append((10 * i, " ".join(base)))
        for k in range(1, 6):  # k words replaced, far apart: 5 k of 196 shingles differ, of 4 words 4 k of 197
            copy = list(base)
            for j in range(k):
                copy[20 + 40 * j] = f"new{i}x{k}x{j}"
            rows.append((10 * i + k, " ".join(copy if rng.random() < 0.8 else copy + text(30))))
    # 5-word shingles 0.814, 4-word ones 0.848: only the stage's rule links them
    base = text(200)
    rows += [(900, " ".join(base)), (901, " ".join([*base[:20], "a", *base[21:80], "b", *base[81:140], "c", *base[141:180], "d", *base[181:]]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    links, reach = plain_near_copies(rows)
    assert (900, 901) in links and (900, 901) not in plain_near_copies(rows, 4, 85)[0]
    assert not set(plain_near_copies(rows, 4, 85)[0]) - set(links)
    left = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs.repartition(4), ROOT).collect()}
    assert left == {i for i in reach if reach[i] == i}
    assert left < {i for i, c in plain_components(rows).items() if c == i}


def test_one_row_of_an_id_and_text_stays(spark):
    long, other = "a b c d e f " * 20, "g h i j k " * 20
    rows = [(1, long), (1, long), (1, other), (2, None), (2, None), (2, ""), (None, "x y"), (None, "x y"), (None, "z"), (3, long)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs.repartition(4), ROOT).collect()]
    assert sorted(map(repr, left)) == sorted(map(repr, set(rows) - {(3, long)}))


def test_mix(stages):
    before = {r[0]: r for r in table(stages[3][0])}
    after = table(stages[3][1])
    assert all(before[r[0]] == r for r in after)
    copies = {k: 0 for k in before}
    for r in after:
        copies[r[0]] += 1
    for doc_id, size, _, _, taken in table(stages[3][0], sql.SOURCE_MIXING):
        assert copies[doc_id] * size == taken


def test_ids(stages):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r[0]: r[1] for r in table(stages[4][0])}
    rows = table(stages[4][1], "SELECT doc_id, n_tokens, ids, round_trip FROM documents")
    assert len(rows) == len(table(stages[4][0]))
    for doc_id, n, ids, same in rows:
        assert same and n == len(ids) and ids == library.encode_ordinary(texts[doc_id])


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, ROOT).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(r for r in table(stages[4][1], "SELECT doc_id, n_tokens FROM documents"))


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (None, "some words here", "en", None, 15, None),
            (2, "the same text", "en", "s", 13, "y"), (2, "the same text", "en", "s", 13, "y"), (3, "1 2 3", None, "s", 5, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    for start in (docs, docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, start, ROOT)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            out.collect()
