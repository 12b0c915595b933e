"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posterior labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phaseloom.llm.common import stored
from phaseloom.llm.shingles import shingle_sets, signatures
from phaseloom.llm.tokens import blocks, tidy

#: General insults, a voter for each language.
LEXICONS = {
    "en": "idiot idiots moron morons loser losers scum stupid trash worthless pathetic disgusting clown clowns dumb jerk fool fools filthy garbage bastard bastards asshole bitch cretin imbecile vermin coward cowards liar liars ugly vile rotten freak freaks useless disgrace ignorant braindead degenerate parasite parasites subhuman".split(),
    "de": "idiot idioten trottel abschaum dumm dumme dummer müll wertlos wertlose erbärmlich erbärmliche widerlich widerliche arschloch depp deppen blöd blöde schwein schweine versager lügner feigling hässlich mistkerl spinner vollidiot dreckig dreck ekelhaft nutzlos nutzlose schwachkopf dummkopf drecksack ungeziefer parasit".split(),
    "fr": "idiot idiots idiote imbécile imbéciles ordure ordures stupide stupides minable minables dégoûtant dégoûtante crétin crétins abruti abrutis connard connards débile débiles salaud salope merde bouffon raté lâche menteur pourri pourriture déchet racaille vermine parasite inutile ignoble répugnant".split(),
    "es": "idiota idiotas imbécil imbéciles basura estúpido estúpida estúpidos inútil inútiles patético patética asqueroso asquerosa escoria tonto tonta payaso payasos cobarde mentiroso mierda cabrón gilipollas perdedor cerdo repugnante despreciable parásito ignorante feo fea bobo zorra".split(),
}
PATTERNS = ["[!?]{2,}", "\\b[A-Z]{4,}(?:\\W+[A-Z]{3,}){2}"]  # runs of marks; shouting
PREFIXES = (4, 5, 6)
MINED_VOTERS = 6


#: MinHash values by which rows of the sample are told to be near copies, and the share that must agree.
FAMILY_VALUES, FAMILY_LIKENESS = 64, 0.7
REPEATS = (1, 2)  # a feature is a word or beginning that a text has so many times at least
#: Where no labels tell otherwise: the toxic share, and how often lexicons and patterns vote in toxic and in clean texts.
PRIOR, LEXICON_RATES, PATTERN_RATES = 0.1, (0.4, 0.005), (0.3, 0.05)


@dataclass(frozen=True)
class Weak:
    sample: int = 24_000  # about so many labelled rows at most, half of each class, are used to find words and to fit; about as many unlabelled ones to fit
    least_ratio: float = 8.0  # of a found feature's share of toxic rows to its share of others
    label_accuracy: float = 0.95  # of a given label, as one more voter on its own row
    unlabelled: float = 0.5  # what all unlabelled rows count for in the fit beside all labelled ones
    rounds: int = 30
    pseudo: float = 50.0  # toxic rows that the assumed rates count for where there are no labels
    correlated: float = 0.1  # excess correlation within a class above which two voters share weight
    threshold: float = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of doc_id as text leaves 2 modulo 4. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each word's text and number in the distinct words, and these: runs of letters in lower case."""
    cut = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")), "\\PL+")
    coded = cut.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    return owner, coded.indices.to_numpy(), coded.dictionary


def _beginnings(words: pa.Array, n: int) -> tuple[np.ndarray, pa.Array]:
    """For each word its beginning's number (-1: it is shorter) and the distinct beginnings of n letters."""
    long = pc.greater_equal(pc.utf8_length(words), n)
    coded = pc.if_else(long, pc.utf8_slice_codeunits(words, 0, n), None).dictionary_encode()
    return pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False), coded.dictionary


def _sample(labels: DataFrame, weak: Weak) -> tuple[DataFrame, dict[int, float]]:
    """doc_id and toxic of labelled rows that are not held out, thinned by a hash of doc_id to half of `sample` in each class.

    Also each class's weight, the number of labelled rows that a row of the sample stands for.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {k: min(1, weak.sample / 2 / max(1, sizes.get(k, 0))) for k in (0, 1)}
    place = F.xxhash64(F.lit(3), "doc_id")
    inside = lambda k: F.lit(True) if share[k] == 1 else place < F.lit(int(share[k] * 2**64) - 2**63).cast("long")
    thinned = known.where(F.when(F.col("toxic") == 1, inside(1)).otherwise(inside(0)))
    return stored(thinned, "toxic-sample"), {k: 1 / max(share[k], 2**-64) for k in share}


def _one_a_family(sample_texts: DataFrame) -> DataFrame:
    """doc_id of the rows of the sample but for near copies of another: rows with the least shingle hash of an earlier one and MinHash values like its.

    A text that was copied often would make its rare words look like marks of its class. A text that has only a common
    sentence with others differs in most values and stays.
    """

    def least(batches):
        for b in blocks(batches, "text"):
            sets = shingle_sets(b.column("text"), 5)
            own = [int(s[0].astype(np.int64)) if len(s) else None for s in sets]
            values = iter(signatures([s for s in sets if len(s)], FAMILY_VALUES, 5).astype(np.int64).tolist() if any(len(s) for s in sets) else [])
            sigs = [next(values) if len(s) else [0] * FAMILY_VALUES for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(own, pa.int64()), pa.array(sigs, pa.list_(pa.int64()))], ["doc_id", "family", "sig"])
        tidy()

    rows = stored(sample_texts.select("doc_id", "text").mapInArrow(least, "doc_id long, family long, sig array<long>"), "toxic-families")
    heads = rows.groupBy("family").agg(F.min(F.struct("doc_id", "sig")).alias("head"))
    same = F.size(F.filter(F.zip_with("sig", "head.sig", lambda a, b: a == b), lambda x: x))
    met = rows.join(heads, rows["family"].eqNullSafe(heads["family"]))
    return met.where((F.col("doc_id") == F.col("head.doc_id")) | (same < FAMILY_LIKENESS * FAMILY_VALUES)).select("doc_id").distinct()


def _mine(sample_texts: DataFrame, weak: Weak) -> list[str]:
    """Features that toxic rows of the sample have more often than others, most certain first.

    A feature is a word ('1w:...') or a word's beginning ('1p:...'), or that it comes twice or more ('2w:...', '2p:...').
    """

    def count(batches):
        for b in blocks(batches, "text"):
            toxic = b.column("toxic").to_numpy()
            owner, word, words = _words(b.column("text"))
            maps = [("w:", np.arange(len(words)), words), *(("p:", *_beginnings(words, n)) for n in PREFIXES)]
            for mark, of, names in maps:
                number = of[word] if len(word) else word
                width = max(1, 2 * len(words))
                pairs, times = np.unique(owner[number >= 0].astype(np.int64) * width + number[number >= 0], return_counts=True)
                for least in REPEATS:
                    doc, k = pairs[times >= least] // width, pairs[times >= least] % width
                    n = np.bincount(k, minlength=len(names))
                    t = np.bincount(k, weights=toxic[doc], minlength=len(names)).astype(np.int64)
                    met = np.flatnonzero(n)
                    own = pc.binary_join_element_wise(f"{least}{mark}", names.cast(pa.string()).take(pa.array(met)), "")
                    yield pa.RecordBatch.from_arrays([own, pa.array(t[met]), pa.array((n - t)[met])], ["feature", "t", "c"])
            total = np.array([toxic.sum()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array(total), pa.array(len(toxic) - total)], ["feature", "t", "c"])

    sums = stored(
        sample_texts.mapInArrow(count, "feature string, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c")),
        "toxic-words",
    )
    whole = sums.where("feature = ''").first()
    if whole is None or not whole["t"] or not whole["c"]:
        return []
    p = whole["t"] / (whole["t"] + whole["c"])
    sums = sums.where("length(feature) > 3 and t + c > 2")
    least_g = 2 * np.log(max(2, sums.count()))  # about one feature passes by chance
    ratio = (F.col("t") / whole["t"]) / ((F.col("c") + 0.5) / whole["c"])
    part = lambda k, q: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (F.col("t") + F.col("c")) / q)).otherwise(0.0)
    found = (
        sums.where(ratio >= weak.least_ratio)
        .withColumn("g", 2 * (part("t", p) + part("c", 1 - p)))
        .where(F.col("g") >= float(least_g))
    )
    return [r["feature"] for r in found.orderBy(F.desc("g"), "feature").collect()]  # no more than a bounded sample can single out


N_VOTERS = len(LEXICONS) + MINED_VOTERS + len(PATTERNS)


@dataclass(frozen=True)
class Voters:
    """What is looked for in a text: lexicons, found features (dealt out to MINED_VOTERS sets in turn), patterns."""

    features: list[str]

    def look(self):
        """A function from a text array to each text's found features (a list) and votes (bits)."""
        number = {f: k for k, f in enumerate(self.features)}
        lexicon: dict[str, int] = {}
        for k, words in enumerate(LEXICONS.values()):
            for w in words:
                lexicon[w] = lexicon.get(w, 0) | 1 << k
        base = len(LEXICONS)
        least = {name: [(n, number[f"{n}{name}"]) for n in REPEATS if f"{n}{name}" in number] for name in {f[1:] for f in self.features}}

        def find(texts: pa.Array) -> tuple[list[list[int]], np.ndarray]:
            owner, word, words = _words(texts)
            votes = np.zeros(len(texts), np.int64)
            known: list[tuple[int, list[str], int]] = []
            for k, w in enumerate(words.to_pylist()):
                own = [f for f in (f"w:{w}", *(f"p:{w[:n]}" for n in PREFIXES if len(w) >= n)) if f in least]
                if own or w in lexicon:
                    known.append((k, own, lexicon.get(w, 0)))
            slot = np.full(len(words), -1, np.int64)
            slot[[k for k, _, _ in known]] = np.arange(len(known))
            at = slot[word] if len(word) else word
            pairs, times = np.unique(owner[at >= 0].astype(np.int64) * max(1, len(known)) + at[at >= 0], return_counts=True)
            counts: dict[int, dict[str, int]] = {}
            for p, n in zip(pairs.tolist(), times.tolist(), strict=True):
                doc, k = divmod(p, len(known))
                votes[doc] |= known[k][2]
                of = counts.setdefault(doc, {})
                for name in known[k][1]:
                    of[name] = of.get(name, 0) + n
            found: list[list[int]] = [[] for _ in range(len(texts))]
            for doc, of in counts.items():
                found[doc] = sorted(k for name, n in of.items() for m, k in least[name] if n >= m)
                for k in found[doc]:
                    votes[doc] |= 1 << (base + k % MINED_VOTERS)
            texts = pc.fill_null(texts.cast(pa.string()), "")
            for k, pattern in enumerate(PATTERNS):
                votes |= pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.int64) << (base + MINED_VOTERS + k)
            return found, votes

        return find


def _hits(docs: DataFrame, voters: Voters) -> DataFrame:
    """doc_id, features found in the whole text, and its votes as bits; stored."""

    def run(batches):
        find = voters.look()
        for b in blocks(batches, "text"):
            found, votes = find(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.list_(pa.int32())), pa.array(votes)], ["doc_id", "found", "votes"])
        tidy()

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(source.mapInArrow(run, "doc_id long, found array<int>, votes long"), "toxic-hits")


@dataclass
class LabelModel:
    """Log odds of the toxic class: a prior, and a weight for each vote and each missing vote."""

    prior: float
    yes: np.ndarray
    no: np.ndarray
    toxic_rate: np.ndarray
    clean_rate: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        return self.prior + votes @ self.yes + (1 - votes) @ self.no


def fit_label_model(votes: np.ndarray, counts: np.ndarray, toxic: np.ndarray, clean: np.ndarray, weak: Weak) -> LabelModel:
    """EM for voters' rates in two hidden classes, from distinct vote patterns with the number of rows that have each.

    counts: all rows; toxic and clean: those of them that are labelled so (estimates from a sample may exceed a
    pattern's rows; they also give the start). A voter's accuracy is its rate in either class. Pairs of voters that agree more often within the classes than their
    rates explain are correlated: their weights are divided by one plus the sum of the excess correlations.
    """
    n = counts.astype(float)
    if toxic.sum() and clean.sum():
        prior = (toxic.sum() + 1) / (toxic.sum() + clean.sum() + 2)
        rate, other = (toxic @ votes + 0.5) / (toxic.sum() + 5), (clean @ votes + 0.5) / (clean.sum() + 50)
        (t1, t0), (c1, c0), (p1, p0) = (0.5, 5), (0.5, 50), (1, 2)
    else:  # assumed rates, which count for some rows beside those that there are
        kinds = [LEXICON_RATES] * len(LEXICONS) + [(0.01, 0.01)] * MINED_VOTERS + [PATTERN_RATES] * len(PATTERNS)  # nothing is found
        prior, rate, other = PRIOR, np.array([k[0] for k in kinds])[: votes.shape[1]], np.array([k[1] for k in kinds])[: votes.shape[1]]
        t0, c0 = weak.pseudo, weak.pseudo / PRIOR
        t1, c1, p1, p0 = t0 * rate, c0 * other, t0, t0 + c0
    most = np.minimum(1, n / np.maximum(toxic + clean, 1))
    toxic, clean = toxic * most, clean * most
    free = np.maximum(n - toxic - clean, 0)
    anchor = np.log(weak.label_accuracy / (1 - weak.label_accuracy))
    for _ in range(weak.rounds):
        rate, other = np.clip(rate, 1e-4, 1 - 1e-4), np.clip(other, 1e-5, 1 - 1e-4)
        yes, no = np.log(rate / other), np.log((1 - rate) / (1 - other))
        base = np.log(prior / (1 - prior)) + votes @ yes + (1 - votes) @ no
        p = [1 / (1 + np.exp(-np.clip(base + s, -30, 30))) for s in (0, anchor, -anchor)]
        t = free * p[0] + toxic * p[1] + clean * p[2]
        c = n - t
        prior = (t.sum() + p1) / (n.sum() + p0)
        rate, other = (t @ votes + t1) / (t.sum() + t0), (c @ votes + c1) / (c.sum() + c0)
    excess = np.zeros((votes.shape[1],) * 2)
    for weight, q, own in ((t, rate, t0), (c, other, c0)):
        joint = ((votes * weight[:, None]).T @ votes + own * np.outer(q, q)) / (weight.sum() + own)
        spread = np.sqrt(np.maximum(q * (1 - q), 1e-9))
        excess = np.maximum(excess, (joint - np.outer(q, q)) / np.outer(spread, spread))
    np.fill_diagonal(excess, 0)
    share = 1 + np.where(excess > weak.correlated, excess, 0).sum(1)
    return LabelModel(float(np.log(prior / (1 - prior))), yes / share, no / share, rate, other)


def fit_linear(
    rows: np.ndarray, cols: np.ndarray, target: np.ndarray, width: int, weight: np.ndarray | None = None, l2: float = 1e-4, steps: int = 400
) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression on 0/1 features at (rows, cols) to target probabilities.

    weight: what each row counts for (1 without it).
    """
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    weight = np.ones(len(target)) if weight is None else weight
    n = max(1, weight.sum())
    for k in range(1, steps + 1):
        z = w[-1] + np.bincount(rows, weights=w[cols], minlength=len(target)) if len(rows) else np.full(len(target), w[-1])
        r = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        g = np.append(np.bincount(cols, weights=r[rows], minlength=width)[:width] if len(rows) else np.zeros(width), r.sum()) / n
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w


def _bits(votes) -> np.ndarray:
    return (np.asarray(votes, np.int64)[:, None] >> np.arange(N_VOTERS)) & 1


@dataclass(frozen=True)
class Toxicity:
    """A fitted scorer: voters and the weights of their features, their votes, and the bias."""

    voters: Voters
    weights: np.ndarray

    def score(self, found: pa.Array, votes: np.ndarray) -> np.ndarray:
        sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
        own = np.bincount(np.repeat(np.arange(len(found)), sizes), weights=self.weights[found.flatten().to_numpy()], minlength=len(found))
        z = self.weights[-1] + own + _bits(votes) @ self.weights[len(self.voters.features) : -1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, weak: Weak = Weak()) -> tuple[Toxicity, DataFrame]:
    """The scorer for docs, and the stored votes of all rows.

    Voters are lexicons of four languages, six sets of features found in a bounded sample of labelled rows
    (Weak.sample, one row of each family of near copies), and two patterns. All rows vote with their whole texts; the distinct patterns of votes (at most
    2^12) with their counts over all rows fit the label model. Its posterior labels, on the labelled sample and on a
    sample of unlabelled rows, train a linear classifier on the found features and the votes. Label model and
    classifier weight the sample's rows by the inverse of their class's sampling rate, so that thinning does not
    shift the classes' shares. Rows held out are in no sample, nor are their labels among those that the model sees.

    Without labels of both classes, lexicons and patterns decide by assumed rates, which the texts' own votes move
    the more the more texts there are.
    """
    sample, counts_for = _sample(labels, weak)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    told = texts.join(F.broadcast(sample), "doc_id")  # at most about Weak.sample rows of 12 bytes
    voters = Voters(_mine(told.join(F.broadcast(_one_a_family(told)), "doc_id", "left_semi"), weak))
    hits = _hits(docs, voters)
    told = hits.join(F.broadcast(sample), "doc_id")
    known = told.groupBy("votes").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("k"))
    patterns = hits.groupBy("votes").count().join(known, "votes", "left").fillna(0, ["t", "k"]).orderBy("votes").collect()
    column = lambda name: np.array([r[name] for r in patterns], float)
    t, k = column("t"), column("k")
    model = fit_label_model(_bits([r["votes"] for r in patterns]), column("count"), t * counts_for[1], (k - t) * counts_for[0], weak)
    n_features = len(voters.features)
    if not (t.sum() and (k - t).sum()):
        return Toxicity(voters, np.concatenate([np.zeros(n_features), model.yes - model.no, [model.prior + model.no.sum()]])), hits
    anchor = np.log(weak.label_accuracy / (1 - weak.label_accuracy))
    rows = told.select("found", "votes", "toxic").toArrow()
    toxic = rows["toxic"].to_numpy()
    free = hits.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).join(F.broadcast(sample), "doc_id", "left_anti")
    share = min(1.0, weak.sample / max(1.0, float(column("count").sum())))
    free = free.where(F.xxhash64(F.lit(5), "doc_id") <= F.lit(min(2**63 - 1, int(share * 2**64) - 2**63)).cast("long")).select("found", "votes").toArrow()
    found = pa.chunked_array([*rows["found"].chunks, *free["found"].chunks], pa.list_(pa.int32())).combine_chunks()
    votes = _bits(np.concatenate([rows["votes"].to_numpy(), free["votes"].to_numpy()]))
    odds = model.log_odds(votes)
    odds[: len(rows)] += np.where(toxic == 1, anchor, -anchor)
    weight = np.where(toxic == 1, counts_for[1], counts_for[0])
    weight = np.concatenate([weight, np.full(len(free), weak.unlabelled * weight.sum() / max(1, len(free)))])
    sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False)
    vr, vc = np.nonzero(votes)
    at = np.concatenate([np.repeat(np.arange(len(votes)), sizes), vr])
    cols = np.concatenate([found.flatten().to_numpy().astype(np.int64), vc + n_features])
    target = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return Toxicity(voters, fit_linear(at, cols, target, n_features + N_VOTERS, weight)), hits


def score_toxicity(docs: DataFrame, labels: DataFrame, weak: Weak = Weak()) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= threshold) of every row of docs, by fit().

    Only texts are inputs of a score; lang, source, labels and doc_id are not. Null and empty texts get the score of a
    text without any vote. Repeated rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    model, hits = fit(docs, labels, weak)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for b in batches:
            scores = sent.value.score(b.column("found"), b.column("votes").to_numpy())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    out = hits.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= weak.threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, weak: Weak = Weak()) -> DataFrame:
    """docs, all columns, without the rows that are predicted toxic.

    The fitted scorer judges each row by its own text where it lies, so rows without a doc_id or with a repeated one
    are judged like all others and no text is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, weak)[0])

    @F.arrow_udf("boolean")
    def toxic(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = sent.value.voters.look()
        for own in texts:
            parts = [pa.array([], pa.bool_())]
            for b in blocks([pa.RecordBatch.from_arrays([own], ["text"])], "text"):
                found, votes = find(b.column("text"))
                parts.append(pa.array(sent.value.score(pa.array(found, pa.list_(pa.int32())), votes) >= weak.threshold))
            yield pa.concat_arrays(parts)

    return docs.where(~toxic(F.col("text").cast("string")))
