"""Edge cases that every operator defines: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from phaseloom.llm import chat, common, exact_dedup, fingerprints, mixing, near_dedup, packing, sharding, token_store, toxicity, url_filter

LONG = "some words of a long text. " * 3000
ROWS = [
    (5, None, "en", "src0"),
    (3, "", None, "src1"),
    (None, "no id here, five words and more", "en", None),
    (7, "Copy  of\na text with five words", "en", "src0"),
    (8, "Copy of a text with five words", "de", "src9"),
    (8, "Copy of a text with five words", "de", "src9"),
    (9, LONG, "fr", "src13"),
    (10, "   \n\t ", "fr", "src13"),
    (11, "ümläut \u241b İ. 漢字\u3000x", "xx", "other"),
    (12, "two words", "en", "src0"),
    (13, "end <|endoftext|> start <|startoftext|>x", "en", "src0"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns with names that operators use themselves.
CLASHES = ["size", "shard", "key", "n", "digest", "label", "node", "part", "rank", "score", "_pos", "_range", "_tie", "start", "length", "bucket", "domain", "tokens", "_row", "_file", "_key", "_id", "_doc", "__dedup_key", "_digest", "votes"]
BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_sharding(spark, docs, none):
    out = sharding.assign_shards(docs, 3).collect()
    assert len(out) == len(ROWS)
    assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in out)[0] == (False, None)
    placed = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in placed] == sorted([r[0] for r in ROWS], key=lambda x: (x is not None, x))
    assert {r["size"] for r in out if r["doc_id"] in (3, 5)} == {1}
    assert all(r["text_crc32"] == zlib.crc32(LONG.encode()) for r in out if r["doc_id"] == 9)
    for k in range(3):
        assert [r["slot"] for r in placed if r["shard"] == k] == list(range(sum(r["shard"] == k for r in placed)))
    assert sharding.assign_shards(none, 3).count() == 0
    with pytest.raises(ValueError, match="at least 1"):
        sharding.assign_shards(docs, 0)


def test_shards_are_balanced_and_written(spark, tmp_path):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(k), "x" * int(n)) for k, n in enumerate(rng.integers(0, 400, 500))], "doc_id long, text string")
    out = sharding.assign_shards(df, 7)
    sizes = [r[0] for r in out.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 2 * 401
    sharding.write_shards(df, out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 500


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(spark, docs, none):
    out = _by_id(exact_dedup.deduplicate(docs))
    assert sum(map(len, out.values())) == len(ROWS)
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in out[7] + out[8]] == [(7, 3, True), (7, 3, False), (7, 3, False)]
    assert {r["keep_id"] for r in out[3] + out[5]} == {3} and out[5][0]["group_size"] == 2
    assert out[None][0]["kept"] and out[None][0]["keep_id"] is None
    assert out[9][0]["text_sha256"] == hashlib.sha256(_normal(LONG).encode()).hexdigest()
    assert out[10][0]["text_sha256"] == hashlib.sha256(b" ").hexdigest()
    assert exact_dedup.deduplicate(none).count() == 0
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.where("doc_id is not null").select("doc_id").collect()) == [3, 7, 9, 10, 11, 12, 13]


def test_colliding_digests_are_split_by_full_texts(spark):
    texts = ["a", "b", "a", "c", "b ", "b\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = _by_id(exact_dedup.deduplicate(df, digest=lambda t: F.concat(F.lit("same"), F.length(t).cast("string"))))
    assert [out[k][0]["keep_id"] for k in range(6)] == [0, 1, 0, 3, 4, 4]
    assert [out[k][0]["group_size"] for k in range(6)] == [2, 1, 2, 1, 2, 2]


def test_state_goes_on_over_batches(spark):
    df = spark.createDataFrame([(k, f"t{k % 5}") for k in range(40)], "doc_id long, text string").repartition(6)
    out = exact_dedup.deduplicate(df, files_per_batch=1)
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in out.collect()} == {(k, k % 5, 8) for k in range(40)}


def test_state_stays_for_later_tables(spark, tmp_path):
    """A second table is compared with the first: its copies of earlier texts go, whatever their doc_ids, and a repeated call changes nothing."""
    first = [(10, "a"), (11, "b"), (12, "a"), (13, None), (14, "x  y")]
    later = [(1, "a"), (2, "c"), (3, "c"), (4, ""), (5, "x\ny"), (6, "d")]
    frames = []
    for name, rows in (("one", first), ("two", later)):
        spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/{name}")
        frames.append(spark.read.parquet(f"{tmp_path}/{name}"))
    state = f"file://{tmp_path}/state"
    run = lambda k, name: {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.deduplicate(frames[k], state=state, batch=name).collect()}
    one = run(0, "one")
    assert one == {10: (10, 2, True), 11: (11, 1, True), 12: (10, 2, False), 13: (13, 1, True), 14: (14, 1, True)}
    two = run(1, "two")
    assert two == {1: (10, 3, False), 2: (2, 2, True), 3: (2, 2, False), 4: (13, 2, False), 5: (14, 2, False), 6: (6, 1, True)}
    assert run(1, "two") == two
    assert run(0, "one")[12] == (10, 3, False)
    with pytest.raises(ValueError, match="files"):
        exact_dedup.deduplicate(spark.createDataFrame(first, "doc_id long, text string"), state=state, batch="three")


def test_a_state_checks_full_texts_of_earlier_tables(spark, tmp_path):
    same = lambda t: F.concat(F.lit("same"), F.length(t).cast("string"))
    for name, text in (("one", "a"), ("two", "b")):
        spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/{name}")
    exact_dedup.deduplicate(spark.read.parquet(f"{tmp_path}/one"), same, state=f"{tmp_path}/state", batch="one").collect()
    with pytest.raises(ValueError, match="differ"):
        exact_dedup.deduplicate(spark.read.parquet(f"{tmp_path}/two"), same, state=f"{tmp_path}/state", batch="two")


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\u241b1\u241b0<\u241b1s>", "<s><|image|>[/INST]", "", None, "<", "[INST", LONG]
    rows = [(1, k, "assistant" if k % 2 else "user", t, "x") for k, t in enumerate(nasty)] + [(2, 0, "a\nb\u241b</s>", "t", "x"), (2, 0, None, None, "x"), (None, None, "user", "u", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r["conv_id"]: r for r in chat.format_conversations(df).withColumn("back", chat.parsed_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [(t["role"], t["text"]) for t in out[1]["back"]] == [("assistant" if k % 2 else "user", t or "") for k, t in enumerate(nasty)]
    assert out[1]["loss"] == "".join(t or "" for k, t in enumerate(nasty) if k % 2)
    assert [(t["role"], t["text"]) for t in out[2]["back"]] == [("", ""), ("a\nb\u241b</s>", "t")]
    assert out[None]["formatted"] == "[INST]user\nu[/INST]"
    assert chat.format_conversations(df.limit(0)).count() == 0
    digest = {r["conv_id"]: r for r in chat.formatted_digest(df).collect()}
    told = "".join(f"{'assistant' if k % 2 else 'user'}\n{t or ''}\n" for k, t in enumerate(nasty))
    assert digest[1]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert digest[1]["loss_chars"] == len(out[1]["loss"]) and digest[1]["formatted_chars"] == len(out[1]["formatted"])


def test_chat_parts(spark):
    part = lambda kind, text=None, uri=None, w=None, h=None, s=None, p=None: (kind, text, uri, w, h, s, p)
    rows = [
        (1, 0, "user", [part("text", "see <|image|>: "), part("image", uri="i", w=28, h=15), part("audio", uri="a", s=2.5), None]),
        (1, 1, "assistant", [part("text", "ok"), part("document", uri="d", p=2), part("odd")]),
        (1, 2, "user", None),
    ]
    out = chat.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn long, role string, text array<{chat.PART}>")).first()
    assert out["formatted"] == "[INST]user\nsee <\u241b1|image|>: <|image|><|audio|>[/INST]<s>ok<|document|></s>[INST]user\n[/INST]"
    assert [(a["turn"], a["type"], a["uri"], a["tokens"]) for a in out["attachments"]] == [(0, "image", "i", 4), (0, "audio", "a", 63), (1, "document", "d", 2048)]
    assert out["expanded_tokens"] == 4 + 63 + 2048


def _ids(path, text):
    t = Tokenizer.from_file(path)
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_packing(spark, docs, none, capacity):
    out = packing.pack(docs, BYTES, capacity=capacity, with_ids=True).collect()
    by_doc: dict = {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text, *_ in {r[0]: r for r in ROWS}.values():
        ids = _ids(BYTES, text)
        copies = 2 if doc_id == 8 else 1
        assert sum(r["length"] for r in by_doc[doc_id]) == copies * len(ids)
        for r in by_doc[doc_id]:
            own = ids[r["start"] : r["start"] + r["length"]]
            assert (len(own), r["ids_crc32"], r["doc_tokens"], bytes(r["ids"])) == (r["length"], _crc(own), len(ids), np.array(own, "<u4").tobytes())
    _check_sequences(out, capacity)
    assert packing.pack(none, BYTES).count() == 0


def _check_sequences(rows, capacity):
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity


def test_shortest_pack_first():
    plan, packs = packing.shortest_pack_first({6: 2, 5: 3, 4: 1, 3: 4, 1: 2}, 10)
    assert packs[:, 2].sum() * 10 >= 6 * 2 + 5 * 3 + 4 + 3 * 4 + 2
    assert (packs[:, 1] <= 10).all()
    assert {int(k): int(plan[plan[:, 0] == k][0, 1]) for k in (6, 5, 4, 3, 1)} == dict.fromkeys((6, 5, 4, 3, 1), 0)


def test_mixing(spark, docs, none):
    out = mixing.mix(docs).collect()
    assert {r["doc_id"] for r in out} <= {r[0] for r in ROWS}
    assert mixing.mix(none).count() == 0
    kept = mixing.mixed_documents(docs, mixing.PRODUCTION)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in out)


def test_mixing_gives_shortages_to_siblings_first(spark):
    """Leaf a/x/s1 has too little: its sibling a/x/s2 takes the rest, and domain b does not."""
    supply = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("b", "x", "s3", 1000)], "domain string, lang string, source string, supply long")
    m = mixing.Mixture("'a'", share=(1, 10), max_epochs=1)
    assert {r["source"]: r["alloc"] for r in mixing.leaf_budgets(supply, m).collect()} == {"s1": 10, "s2": 90, "s3": 100}
    supply = spark.createDataFrame([("a", "x", "s1", 10), ("a", "y", "s2", 20), ("b", "x", "s3", 1000)], "domain string, lang string, source string, supply long")
    m = mixing.Mixture("'a'", share=(1, 2), max_epochs=2)
    assert {r["source"]: r["alloc"] for r in mixing.leaf_budgets(supply, m).collect()} == {"s1": 20, "s2": 40, "s3": 455}


def test_fingerprints(spark, docs, none):
    out = _by_id(fingerprints.edited_fingerprints(docs))
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = {}
    for k, (doc_id, text, *_) in enumerate(order):
        own, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(own) // 2
        want.setdefault(doc_id, []).append((len(own), hashlib.sha256((own[: len(own) - half] + after[:half]).encode()).hexdigest()))
    assert {k: sorted((r["n_chars"], r["edited_sha256"]) for r in v) for k, v in out.items()} == {k: sorted(v) for k, v in want.items()}
    assert out[3][0]["fingerprint"] == out[5][0]["fingerprint"] and out[8][0]["near_next"] in (0.0, 1.0)
    assert fingerprints.edited_fingerprints(none).count() == 0
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "only one")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0


def test_fingerprints_are_homomorphic():
    a, b = "one line.\ntwo lines\nthree", "three\none line.\ntwo lines"
    fa, fb, fc = fingerprints.sums_of([a, b, a + "\nfour"])
    assert (fa == fb).all() and (fa != fc).any()
    assert (fingerprints.changed(fa, [], ["four"]) == fc).all()
    assert (fingerprints.changed(fc, ["four"], []) == fa).all()
    assert (fingerprints.row_of(fingerprints.text_of(fc)) == fc).all()
    assert fingerprints.likeness(fa, fb) == 1.0


def test_likeness_follows_the_share_in_common():
    lines = [f"line number {k}" for k in range(4000)]
    for n in (40, 400, 4000):
        for share in (0.2, 0.5, 0.9):
            m = int(n * share)
            x, y = fingerprints.sums_of(["\n".join(lines[:n]), "\n".join(lines[:m] + [f"other {k}" for k in range(n - m)])])
            assert abs(fingerprints.likeness(x, y) - share) < 0.2


@pytest.mark.parametrize(("n", "m", "common"), [(50_000, 50_000, 0), (50_000, 50_000, 25_000), (50_000, 30, 0), (50_000, 30, 30), (300_000, 300_000, 0)])
def test_likeness_of_very_long_texts(n, m, common):
    x, y = ["\n".join([f"shared {k}" for k in range(common)] + [f"{mark} {k}" for k in range(size - common)]) for mark, size in (("left", n), ("right", m))]
    a, b = fingerprints.sums_of([x, y])
    assert abs(fingerprints.likeness(a, b) - 2 * common / (n + m)) < 0.2
    assert (fingerprints.row_of(fingerprints.text_of(a)) == a).all()


@pytest.mark.parametrize("n", [1, 2, 255, 256, 1000, 1024])
def test_likeness_counts_repeats(n):
    a, b, half = fingerprints.sums_of(["same line\n" * n, "other one\n" * n, "same line\n" * n + "other one\n" * n])
    assert fingerprints.likeness(a, b) < 0.2
    assert abs(fingerprints.likeness(a, half) - 2 / 3) < 0.2


def test_repeats_are_added_and_taken_away():
    a, b = "x\nx\ny", "x\nz\nx\nx"
    fa, fb = fingerprints.sums_of([a, b])
    assert (fingerprints.changed(fa, ["y"], ["z", "x"], {"x": 2, "y": 1}) == fb).all()
    assert (fingerprints.changed(fb, ["z", "x"], ["y"], {"x": 3, "z": 1}) == fa).all()
    assert (fingerprints.changed(fb, ["z"], ["z"]) == fb).all()


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
URLS = [None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "x://www.example.com/en/", "http://example.com", "http://com/", "http://xexample.com/en/", "http://b.net/es/\n/x", "http://net", "http://a.b.c.d.example.com/en/", "http:///p", "a://b://example.com/en/"]


def _verdict(url):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_rules(spark):
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*URLS, URLS[3]])], "page_id long, url string, host string")
    out = {r["page_id"]: r for r in url_filter.judge_urls(df, RULES).collect()}
    assert [tuple(out[k][1:]) for k in range(len(URLS))] == [_verdict(u) for u in URLS]
    assert tuple(out[len(URLS)][1:]) == _verdict(URLS[3])
    assert url_filter.judge_urls(df.limit(0), RULES).count() == 0
    with pytest.raises(ValueError, match="one verdict"):
        url_filter.judge_urls(df, [*RULES, ("block", "com", "/")])


def test_many_rules_go_through_the_cascades(spark):
    rules = [("block" if k % 3 else "allow", f"h{k}.org", "/a/" if k % 2 else "/") for k in range(4000)]
    df = spark.range(9000).select(F.col("id").alias("page_id"), F.format_string("http://x.h%d.org/a/%d", F.col("id") % 6000, "id").alias("url"))
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, rules).collect()}
    by_host = {h: (h + p, v) for v, h, p in rules}
    assert out == {k: by_host.get(f"h{k % 6000}.org", (None, "allow")) for k in range(9000)}


@pytest.mark.parametrize("share", [7, 2000])
def test_cascade_is_exact_on_its_universe(spark, share):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.where(f"substring(key, 2) % {share} = 0")
    levels = url_filter.build_cascade(listed, universe)
    assert len(levels) > 1 or share > 7
    assert sum(x.bits for x in levels) < (url_filter.first_bits(1, share) + 16) * 20_000 / share + 640
    keys = universe.select("key", url_filter._hashes(F.col("key")).alias("h")).select("key", "h.*").toPandas()
    found = url_filter.cascade_has(levels, keys["h1"].to_numpy(), keys["h2"].to_numpy())
    assert (found == (keys["key"].str[1:].astype(int) % share == 0).to_numpy()).all()


def test_near_dedup(spark, docs, none):
    out = _by_id(near_dedup.near_duplicates(docs))
    assert sum(map(len, out.values())) == len(ROWS)
    assert {r["component_id"] for r in out[7] + out[8]} == {7} and not out[8][0]["kept"]
    assert [(out[k][0]["n_shingles"], out[k][0]["component_id"]) for k in (3, 5, 10, 12)] == [(0, 3), (0, 5), (0, 10), (1, 12)]
    assert out[None][0]["kept"] and out[None][0]["n_shingles"] == 3 and out[None][0]["component_id"] is None
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 8").count() == 0


@pytest.mark.parametrize("rows", [1, 3, 151])
def test_near_dedup_of_rows_without_ids(spark, rows):
    """One row a row on tables of any size; near copies without ids are linked with each other and with others."""
    base = [f"w{k}" for k in range(100)]
    near = lambda k: " ".join(base[:k] + ["x"] + base[k + 1 :])
    texts = [(None, near(1)), (None, near(50)), (None, "one of its own kind, with no copy")] + [(k, "the same text in all of these rows") for k in range(50)] + [(None, "the same text in all of these rows")] * 48
    texts += [(None, "k")] * 20 + [(100 + k, near(3) if k == 0 else f"other {k} text {k} of {k} five {k}") for k in range(29)]
    df = spark.createDataFrame(texts[:rows], "doc_id long, text string")
    out = near_dedup.near_duplicates(df).collect()
    assert len(out) == min(rows, len(texts))
    kept = [r["text"] for r in near_dedup.keep_one(df).collect()]
    if rows == 3:
        assert {r["component_id"] for r in out} == {None} and len(kept) == 2 and sum(r["kept"] for r in out) == 2
    if rows == 151:
        found = {(r["doc_id"], r["n_shingles"]): r for r in out}
        assert found[None, 96]["component_id"] == 100 and not found[None, 96]["kept"] and found[100, 96]["kept"]
        assert kept.count("the same text in all of these rows") == 1 and kept.count("k") == 20 and near(1) not in kept


def test_token_store(spark, docs, none):
    path = common.new_path(spark, "store")
    token_store.write_store(docs, WORDS, path)
    out = token_store.read_store(spark, path).collect()
    at = 0
    by_start = {r["start"]: r for r in out}
    assert len(by_start) == len(ROWS)
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = _ids(WORDS, text)
        r = by_start[at]
        assert (r["doc_id"], r["n_tokens"], r["ids_crc32"]) == (doc_id, len(ids), _crc(ids))
        at += len(ids)
    whole = {r["start"]: r for r in token_store.read_ids(spark, path).collect()}
    assert {k: (r["doc_id"], r["n_tokens"]) for k, r in whole.items()} == {k: (r["doc_id"], r["n_tokens"]) for k, r in by_start.items()}
    assert all(zlib.crc32(r["ids"]) == by_start[k]["ids_crc32"] for k, r in whole.items())
    some = token_store.read_ids(spark, path, wanted=spark.createDataFrame([(9,), (77,)], "doc_id long")).collect()
    assert [bytes(r["ids"]) for r in some] == [np.array(_ids(WORDS, LONG), "<u4").tobytes()]
    chunks = spark.read.parquet(f"{path}/parts")
    assert chunks.count() == chunks.select("digest").distinct().count()
    root = token_store.store_root(spark, path)
    assert len(root) == 64 and token_store.read_store(spark, path, root).count() == len(ROWS)
    with pytest.raises(ValueError, match="another root"):
        token_store.read_store(spark, path, "0" * 64)
    empty = common.new_path(spark, "store")
    token_store.write_store(none, WORDS, empty)
    assert token_store.read_store(spark, empty).count() == 0 and token_store.read_ids(spark, empty).count() == 0
    assert len(token_store.store_root(spark, empty)) == 64


def _pieces(spark):
    df = spark.createDataFrame([(k, " ".join(f"word{j * k}" for j in range(900))) for k in range(5)], "doc_id long, text string")
    path = common.new_path(spark, "store")
    token_store.write_store(df, WORDS, path)
    return path


def test_damaged_store_is_told(spark):
    path = _pieces(spark)
    whole = common.stored(spark.read.parquet(f"{path}/parts").withColumn("chunk", F.lit(True)), "copy")
    digest = whole.limit(1).select("digest").first()[0]
    put = lambda df: df.write.mode("overwrite").partitionBy("chunk").parquet(f"{path}/parts")
    put(whole.where(F.col("digest") != digest))
    for read in (token_store.read_store, token_store.read_ids):
        with pytest.raises(Exception, match="a chunk is missing"):
            read(spark, path).collect()
    put(whole.withColumn("ids", F.when(F.col("digest") == digest, F.lit(b"\0\0")).otherwise(F.col("ids"))))
    for read in (token_store.read_store, token_store.read_ids):
        with pytest.raises(Exception, match="damaged"):
            read(spark, path).collect()


def test_tree_tells_missing_and_swapped_recipes(spark):
    path = _pieces(spark)
    recipes = common.stored(spark.read.parquet(f"{path}/recipes"), "copy")
    swapped = recipes.withColumn("doc_id", F.when(F.col("doc_id") == 1, 2).when(F.col("doc_id") == 2, 1).otherwise(F.col("doc_id")))
    for broken in (recipes.where("doc_id <> 3"), swapped):
        broken.write.mode("overwrite").parquet(f"{path}/recipes")
        with pytest.raises(ValueError, match="do not fit the manifest"):
            token_store.read_store(spark, path)


def test_tree_has_levels(spark):
    rows = spark.range(70_000).select(F.col("id").alias("_pos"), F.col("id").alias("doc_id"), F.col("id").alias("start"), F.lit(1).alias("n_tokens"), F.lit(b"x").alias("root"))
    levels = {r["level"]: (r["n"], r["below"]) for r in token_store.merkle_tree(rows).groupBy("level").agg(F.count("*").alias("n"), F.sum("below").alias("below")).collect()}
    assert levels == {1: (274, 70_000), 2: (2, 274), 3: (1, 2)}


def test_join_spread_splits_hot_keys(spark):
    rows = common.stored(spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 1, None).otherwise(F.col("id")).alias("k"), "id"), "rows")
    side = spark.range(0, 1000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        assert sorted(common.join_spread(rows, side, "k", how).select("id", "v").collect()) == sorted(rows.join(side, "k", how).select("id", "v").collect())


@pytest.mark.parametrize(("keys", "there"), [(["a"] * 20 + ["b"], ["b"]), (["a", None, "b"], ["b"]), (["a"], []), ([], ["a"]), ([None] * 9, ["a"]), (["a"] * 20 + ["b"], ["a"])])
def test_join_spread_keeps_rows_of_hot_keys_without_match(spark, keys, there):
    rows = common.stored(spark.createDataFrame(list(enumerate(keys)), "id int, k string"), "rows")
    side = spark.createDataFrame([(k, 1) for k in there], "k string, v int")
    for how in ("inner", "left"):
        got = common.join_spread(rows, side, "k", how).select("id", "k", "v").collect()
        assert sorted(map(str, got)) == sorted(map(str, rows.join(side, "k", how).select("id", "k", "v").collect()))


def test_chunks_move_little_when_ids_are_inserted():
    ids = np.random.default_rng(5).integers(0, 49_000, 20_000).astype(np.uint32)
    more = np.concatenate([ids[:7000], ids[:10], ids[7000:]])
    pieces = lambda x: {x[a:b].tobytes() for a, b in zip([0, *token_store.cuts(x)[:-1]], token_store.cuts(x), strict=True)}
    a, b = pieces(ids), pieces(more)
    assert len(a) > 40 and len(a - b) <= 3
    assert max(len(p) for p in a) <= 4 * token_store.MOST


def test_crc_of_parts():
    rng = np.random.default_rng(2)
    whole = rng.bytes(5000)
    stops = [0, 13, 700, 701, 4096, 5000]
    crc = np.array([zlib.crc32(whole[a:b]) for a, b in zip(stops[:-1], stops[1:], strict=True)], np.int64)
    after = np.array([5000 - b for b in stops[1:]], np.int64)
    assert np.bitwise_xor.reduce(token_store.shifted_crc(crc, after)) == zlib.crc32(whole)


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(20)] + [(None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(docs, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out if r["doc_id"] is not None)
    assert toxicity.score_toxicity(none, labels).count() == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    bad = sum(r["predicted"] for r in out)
    assert kept.count() == len(ROWS) - bad


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "you idiot, you pathetic worthless moron"), (2, "a fine day")], "doc_id long, text string")
    out = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()}
    assert out[1] >= 0.3 > out[2]


def test_rows_without_doc_id_are_judged_by_their_texts(spark):
    insult = "you idiot, you pathetic worthless moron"
    df = spark.createDataFrame([(None, insult), (None, "a fine day"), (4, insult), (4, "another fine day"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(toxicity.without_toxic(df, none).select("text").collect(), key=str) == sorted([("a fine day",), ("another fine day",), (None,)], key=str)


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_on_edge_cases(spark, docs, none, stage):
    import corpus_pipeline
    from conftest import SF

    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, common.stored(docs, "docs"), SF)
    assert f(spark, none, SF).count() == 0
    if name != "packing":
        assert out.columns == docs.columns and 0 < out.count() <= len(ROWS)
        assert {r["doc_id"] for r in out.select("doc_id").collect()} <= {r[0] for r in ROWS}
    else:
        assert {r["doc_id"] for r in out.collect()} == {r[0] for r in ROWS}


def test_pipeline_runs_on_an_empty_table_and_on_edge_cases(spark, docs, none, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    for name, df in (("none", none), ("edge", docs)):
        df.write.parquet(f"file://{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"file://{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, f"file://{tmp_path}/edge").collect()} <= {r[0] for r in ROWS}


def test_toxicity_does_not_depend_on_the_sample(spark):
    """One toxic row in eight; a sample of 600 has both classes in equal parts."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(6000):
        toxic = int(k % 8 == 0)
        mark = ["zorkish"] if rng.random() < (0.5 if toxic else 0.05) else []
        rows.append((k, " ".join([*(f"w{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (12, 2))), *mark]), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4).cache()
    full, thin = (
        {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score_toxicity(df, df, toxicity.Weak(sample=n)).collect()} for n in (24_000, 600)
    )
    assert np.mean([full[k][1] == thin[k][1] for k in full]) > 0.98
    assert abs(np.mean([full[k][0] - thin[k][0] for k in full])) < 0.03


def test_copies_do_not_make_marks_of_their_words(spark):
    """One toxic text that was copied forty times has a rare word, which clean texts have as well."""
    rng = np.random.default_rng(9)
    text = lambda *more: " ".join([*(f"w{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (30, 2))), *more])
    copied = text("zorkish", "plimvort")
    rows = [(text(), 0) for _ in range(400)] + [(text("zorkish"), 1) for _ in range(60)] + [(copied, 1)] * 40 + [(text("plimvort"), None) for _ in range(20)]
    df = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(rows)], "doc_id long, text string, toxic int")
    out = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(df, df).collect()}
    assert not any(out[k] for k in range(500, 520)) and all(out[k] for k in range(400, 500))
