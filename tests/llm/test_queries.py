"""The registered queries over the whole small tables: against SQL where there is some, else against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF
from tokenizers import Tokenizer

from phaseloom.llm import components, tokens
from phaseloom.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    return dict(sorted(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    out = QUERIES[name](spark, SF)
    found = con.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(out.columns)
    order = [columns.index(c) for c in out.columns]
    plain = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert plain(out.collect()) == plain(tuple(r[k] for k in order) for r in found.fetchall())


def _ids(name, texts):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return {k: [*e.ids, 1] for k, e in zip(texts, t.encode_batch_fast([x or "" for x in texts.values()], add_special_tokens=False), strict=True)}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, texts):
    rows = sorted(QUERIES["op1_shards"](spark, SF).collect())
    assert [(r["doc_id"], r["size"], r["text_crc32"]) for r in rows] == [(k, len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()]
    assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)


def test_op4(spark, texts):
    ids = _ids("byte_bpe_50k.json", texts)
    rows = QUERIES["op4_packing"](spark, SF).collect()
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (len(own), _crc(own), len(ids[r["doc_id"]])) == (r["length"], r["ids_crc32"], r["doc_tokens"])
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    assert sum(r["length"] for r in rows) > 0.97 * 2048 * (1 + max(r["sequence_id"] for r in rows))


def test_op6(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op6_fingerprints"](spark, SF).collect()}
    keys = list(texts)
    for k, after in zip(keys, [*keys[1:], keys[0]], strict=True):
        half = len(texts[k]) // 2
        edited = texts[k][: len(texts[k]) - half] + texts[after][:half]
        assert rows[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (rows[k]["fingerprint"] == rows[after]["fingerprint"]) == (rows[k]["near_next"] == 1.0)
    assert np.mean([r["near_edited"] for r in rows.values()]) > 0.3 + np.mean([r["near_next"] for r in rows.values()])


def test_op6_likeness_against_the_multisets(spark):
    """Every row of sf0.01: with its edited text and with the next one, against the true overlap of paragraphs."""
    from collections import Counter

    from phaseloom.llm.fingerprints import paragraphs

    path = SF.replace("sf0.001", "sf0.01")
    t = pq.read_table(f"{path}/documents.parquet", columns=["doc_id", "text"])
    texts = dict(sorted(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True)))
    rows = {r["doc_id"]: r for r in QUERIES["op6_fingerprints"](spark, path).collect()}
    keys, errors = list(texts), []
    for k, after in zip(keys, [*keys[1:], keys[0]], strict=True):
        own, other = texts[k] or "", texts[after] or ""
        half = len(own) // 2
        for name, against in (("near_edited", own[: len(own) - half] + other[:half]), ("near_next", other)):
            a, b = Counter(paragraphs(own)), Counter(paragraphs(against))
            whole = a.total() + b.total()
            errors.append(abs(rows[k][name] - (2 * (a & b).total() / whole if whole else 1.0)))
    assert max(errors) < 0.2 and np.mean(errors) < 0.02


def _sets(texts):
    out = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def _components(sets):
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    index = defaultdict(list)
    for k, s in sets.items():
        shared: dict = defaultdict(int)
        for g in s:
            for j in index[g]:
                shared[j] += 1
            index[g].append(k)
        for j, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                a, b = find(j), find(k)
                root[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}


def test_op8(spark, texts):
    sets = _sets(texts)
    rows = QUERIES["op8_near_dedup"](spark, SF).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {k: len(s) for k, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == _components(sets)


def test_near_group_with_many_members(spark):
    """A base text and 150 edits of it, most pairs below the threshold: the buckets stay open and the prefix filter decides."""
    from phaseloom.llm.near_dedup import near_duplicates

    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(150)]
    texts = {0: " ".join(base)}
    for d in range(1, 151):
        own = list(base)
        for at in rng.choice(150, rng.integers(1, 12), replace=False):
            own[at] = f"e{rng.integers(0, 40)}"
        texts[d] = " ".join(own)
    rows = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == _components(_sets(texts))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_op9(spark, texts):
    ids = _ids("word_bpe_49k.json", texts)
    at = 0
    for r in sorted(QUERIES["op9_token_store"](spark, SF).collect()):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids[r["doc_id"]]), _crc(ids[r["doc_id"]]))
        at += r["n_tokens"]


def test_op10_on_held_out_labels(spark):
    path = SF.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{path}/labels.parquet").to_pylist()}
    rows = QUERIES["op10_toxicity"](spark, path).collect()
    assert len(rows) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    clean = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 0]
    toxic = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 1]
    assert np.mean([r["predicted"] for r in clean]) < 0.05 and np.mean([r["predicted"] for r in toxic]) > 0.5


def test_op10_with_more_labels(spark):
    """At sf0.1 most languages have enough labels to learn from."""
    path = SF.replace("sf0.001", "sf0.1")
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{path}/labels.parquet").to_pylist()}
    rows = [r for r in QUERIES["op10_toxicity"](spark, path).collect() if r["held_out"]]
    assert np.mean([r["predicted"] for r in rows if labels.get(r["doc_id"]) == 1]) >= 0.9
    assert np.mean([r["predicted"] for r in rows if labels.get(r["doc_id"]) == 0]) < 0.01


PIECES = [" ", "  ", "\n", "\n\n", "\t", "a", "B", "é", "ß", ".", ",", "!", "1", "23", "'s", "'", "　", "\xa0", "\x1c", "́", "漢字", "한", "\U0001f600", "Ǆ", "İ", "\r\n", "x", "-", "foo", "The", "\0", "​", "№", "²", "ﬁ", "<|endoftext|>", "<|startoftext|>", "<|", "endoftext|>", "<|ENDOFTEXT|>"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_encoder_equals_the_library(name):
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(PIECES, rng.integers(0, 40))) for _ in range(4000)] + ["", " ", "\n", None]
    own = tokens.WordEncoder(public_tokenizers.path(name), keep=500)
    got = [x for k in range(0, len(texts), 300) for x in own.encode(pa.array(texts[k : k + 300]))]
    want = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_pipeline(spark):
    import corpus_pipeline
    from phaseloom.llm.common import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 50
    kept = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert len(kept) == seen[-1] and len(set(_components(_sets(kept)).values())) == len(kept)
    ids = _ids("byte_bpe_50k.json", kept)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sum(r["length"] for r in out.collect()) == sum(map(len, ids.values()))
    assert [c for c, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
