"""Token ids of whole text columns by the tokenizers library, word by word where that is exact."""

from __future__ import annotations

import ctypes
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Every character that some definition counts as white space.
_SPACE = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_UNSAFE = f"{_SPACE}{{3,}}|{_SPACE}{{2,}}$|\\x00"
# A mark after a letter begins another word; not after U+0130, whose lower case ends in a combining mark.
_STOP = "([A-Za-zÀ-ÖØ-öø-įı-ɏ])([.,;:!?])"


class WordEncoder:
    """Encodes Arrow string arrays to the ids that Tokenizer.encode gives for each whole text.

    Byte-level BPE (GPT-2's pattern, no prefix space) never joins a character with white space after it, and the
    lower-casing word BPE drops white space, so texts are cut there, each distinct word of a batch is encoded once
    and ids are put together by index. Texts with runs of white space that the byte-level pattern reads as one token
    or with the string of an added token, which the library makes that token, and tokenizers of any other kind, are
    encoded whole. Words are kept between batches; when there are more than
    `keep`, those of the last texts stay.
    """

    def __init__(self, path: str, keep: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # for words: those that only lower-casing makes an added token's string are none
        self.plain.encode_special_tokens = True
        spec = json.loads(self.tokenizer.to_str())
        self.kind = self._kind(spec)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.keep = keep
        self.slots: dict[str, int] = {}
        self._empty()
        size = self.tokenizer.get_vocab_size()
        self.edge = np.zeros(size, bool)  # ids that begin (bytes) or end (words) a word of letters
        for token, k in self.tokenizer.get_vocab().items():
            self.edge[k] = token.startswith("Ġ") if self.kind == "bytes" else token.endswith("</w>")

    @staticmethod
    def _kind(spec: dict) -> str:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        if any(t.get("normalized") or t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens") or []):
            return "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return "bytes"
        first = (pre.get("pretokenizers") or [{}])[0]
        steps = [x.get("type") for x in norm.get("normalizers", [])]
        if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and steps == ["NFC", "Replace", "Lowercase"]:
            return "words"
        return "whole"

    def _empty(self) -> None:
        self.slots = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        k, end = len(self.slots), self.used + len(ids)
        while end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while k + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.pool[self.used : end] = ids
        self.starts[k + 1 : k + 1 + len(words)] = self.used + np.cumsum(counts)
        self.used = end
        self.slots.update(zip(words, range(k, k + len(words)), strict=True))

    def _ids_of(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in these slots, one after the other, and how many each has."""
        first, length = self.starts[slot], self.starts[slot + 1] - self.starts[slot]
        ends = np.cumsum(length)
        return self.pool[np.repeat(first - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)], length

    def _forget(self, words: list[str]) -> None:
        """Keeps of the known words only these."""
        known = [w for w in words if w in self.slots]
        ids, counts = self._ids_of(np.fromiter(map(self.slots.__getitem__, known), np.int64, len(known)))
        self._empty()
        self._add(known, ids, counts)

    def _learn(self, words: list[str]) -> None:
        """Encodes new words; those of letters only are joined to one text, as their ids show where each begins or ends."""
        letters = pc.match_substring_regex(pa.array(words), "^ \\pL+$" if self.kind == "bytes" else "^\\pL+$").to_numpy(zero_copy_only=False)
        plain = [w for w, ok in zip(words, letters.tolist(), strict=True) if ok]
        other = [w for w, ok in zip(words, letters.tolist(), strict=True) if not ok]
        for k in range(0, len(plain), 20_000):
            part = plain[k : k + 20_000]
            text = "".join(part) if self.kind == "bytes" else " ".join(part)
            ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(part):
                other.extend(part)
            elif self.kind == "bytes":
                self._add(part, ids, np.diff(edges, append=len(ids)))
            else:
                self._add(part, ids, np.diff(edges, prepend=-1))
        for k in range(0, len(other), 20_000):
            part = other[k : k + 20_000]
            got = self.plain.encode_batch([part], is_pretokenized=True, add_special_tokens=False)[0]
            ids = np.array(got.ids, np.uint32)
            owner = np.array(got.word_ids, np.int64)
            self._add(part, ids, np.bincount(owner, minlength=len(part)) if len(ids) else np.zeros(len(part), np.int64))

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.kind == "words":
            texts = pc.ascii_lower(pc.replace_substring_regex(texts, _STOP, "\\1 \\2"))
            cut = pc.ascii_split_whitespace(texts)
        else:
            texts = pc.replace_substring_regex(texts, _STOP, "\\1\0\\2")
            texts = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
            cut = pc.split_pattern(texts, "\0")
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.slots) > self.keep or self.used > 8 * self.keep:
            self._forget(words)
        if new := [w for w in words if w not in self.slots]:
            self._learn(new)
        slot = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
        ids, length = self._ids_of(slot[coded.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(length)])
        return ids, ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without special tokens; a null text counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return []
        if self.kind == "whole":
            return self._whole(texts.to_pylist())
        ids, bounds = self._by_word(texts)
        out = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        unsafe = [pc.match_substring(texts, a) for a in self.added]
        if self.kind == "bytes":
            unsafe.append(pc.match_substring_regex(texts, _UNSAFE))
        odd = np.flatnonzero(np.any([u.to_numpy(zero_copy_only=False) for u in unsafe], axis=0)) if unsafe else np.zeros(0, np.int64)
        for k, own in zip(odd.tolist(), self._whole(texts.take(pa.array(odd)).to_pylist()), strict=True):
            out[k] = own
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def tidy() -> None:
    """Gives memory that a task has freed back to the system: idle Python workers stay alive beside an executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def blocks(batches, column: str, most_bytes: int = 2 << 20, most_rows: int = 1 << 30):
    """Slices of the batches whose texts have about most_bytes together (one longer text makes a slice of its own), of most_rows rows at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            stop = max(start + 1, min(start + most_rows, int(np.searchsorted(size, base + most_bytes, side="right"))))
            yield batch.slice(start, stop - start)
            start = stop
