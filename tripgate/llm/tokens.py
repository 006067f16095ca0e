"""Token counts of a byte-level BPE with word ends, by dynamic programming over prefixes.

For every prefix of a word the table holds the last token of its encoding and the number
of tokens. A sequence of tokens is the encoding of its text exactly when each token
encodes to itself and each neighbouring pair encodes to that pair, so the last token of a prefix is the one
vocabulary entry that ends there and fits the last token before it. One table thus has the
exact count at every prefix of a word; summed over words it has the count at every prefix
of a text, which answers truncation and budget questions without encoding again.

Beginnings that words share are kept, up to ``SHARED`` symbols; beyond that a word's table is
its own, so memory grows with the length of the longest word and not with its square.

Defined cases: null and empty texts have 0 tokens; the vocabulary's special strings inside
a text count one each, as the library's default has it; repeated rows are counted each; words
of any length are counted whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgate.llm.common import ship

END = "</w>"
LIMIT = 2048
#: Symbols up to which beginnings are kept for other words, and characters up to which words are.
SHARED = 32
_NEVER = 1 << 60
_COUNTERS: dict[int, PrefixCounter] = {}


def _byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next free one from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(128, 0x300) if unicodedata.category(chr(c))[0] == kind)


#: Texts of these characters only are their own NFC form, and lower() and the classes below are the library's.
_PLAIN = re.compile("[^\t-\r -~¡-˿]")
_L, _N = "a-zA-Z" + _class("L"), "0-9" + _class("N")
_SPLIT = re.compile(f"[{_L}]+|'(?:s|t|re|ve|m|ll|d)|[{_N}]|[^\\s{_L}{_N}]+")
_SPLIT_ASCII = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9]+")


class _Known(dict):
    """Counts of words met before; the rest are computed on the way, and all forgotten when they grow many."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, word: str) -> int:
        got = self.compute(word)
        if len(word) <= SHARED:
            if len(self) > 700_000:
                self.clear()
            self[word] = got
        return got


class PrefixCounter:
    """Counts for one vocabulary file of the ``tokenizers`` library, given as its text."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        model = json.loads(spec)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.tokens = list(model["model"]["vocab"])
        self.inner, self.ending = self._backwards(False), self._backwards(True)
        self.special = [t["content"] for t in model.get("added_tokens", [])]
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.alphabet = _byte_alphabet()
        self.library = Tokenizer.from_str(spec)
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.front: dict[str, tuple[int, int]] = {}
        self.known = _Known(lambda word: self.table(word)[-1])

    def merged(self, parts: list[str]) -> list[str]:
        """Merges by rank, leftmost first, until none applies."""
        rank = self.rank.get
        ranks = [rank(pair, _NEVER) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != _NEVER:
            i = ranks.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), _NEVER)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), _NEVER)
        return parts

    @staticmethod
    def symbols(token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def _backwards(self, ending: bool) -> dict:
        """The tokens with or without a word end as a trie over their symbols from the last to the first; at 0 the token's number."""
        root: dict = {}
        for number, token in enumerate(self.tokens):
            if (token.endswith(END) and len(token) > len(END)) == ending:
                node = root
                for c in reversed(token.removesuffix(END) if ending else token):
                    node = node.setdefault(c, {})
                node[0] = number
        return root

    def fit(self, before: int, token: int) -> bool:
        """Whether both tokens, put together, encode to just these two."""
        pair = [self.tokens[before], self.tokens[token]]
        return self.merged(self.symbols(pair[0]) + self.symbols(pair[1])) == pair

    def single(self, token: int) -> bool:
        got = self.whole[token] = self.merged(self.symbols(self.tokens[token])) == [self.tokens[token]]
        return got

    def _last(self, s: str, i: int, last: list[int], trie: dict) -> tuple[int, int]:
        """Start and number of the last token of the prefix of i symbols."""
        ends, node, j = [], trie, i
        while j and (node := node.get(s[j - 1])) is not None:
            j -= 1
            if 0 in node:
                ends.append((j, node[0]))
        whole, fits = self.whole, self.fits
        for j, token in reversed(ends):
            ok = whole.get(token)
            if ok or ok is None and self.single(token):
                if j == 0:
                    return 0, token
                key = last[j] << 20 | token
                ok = fits.get(key)
                if ok is None:
                    if len(fits) > 1_000_000:
                        fits.clear()
                    ok = fits[key] = self.fit(last[j], token)
                if ok:
                    return j, token
        raise AssertionError(f"no token ends at {i} of {s!r}")

    def table(self, word: str, ends: bool = False) -> list[int]:
        """Counts at each prefix of a pre-token's byte symbols if cut there (``ends``), else of the whole only."""
        s = "".join(self.alphabet[b] for b in word.encode())
        last, count, out, front = [-1], [0], [], self.front
        if len(front) > 700_000:
            front.clear()
        for i in range(1, len(s) + 1):
            if ends or i == len(s):
                out.append(count[self._last(s, i, last, self.ending)[0]] + 1)
            if i < len(s):
                got = front.get(s[:i]) if i <= SHARED else None  # words share beginnings
                if got is None:
                    j, token = self._last(s, i, last, self.inner)
                    got = token, count[j] + 1
                    if i <= SHARED:
                        front[s[:i]] = got
                last.append(got[0])
                count.append(got[1])
        return out

    def _segments(self, text: str) -> Iterator[tuple[int, str, bool]]:
        """(start, segment, special)."""
        at = 0
        for m in self.cut.finditer(text) if self.cut else ():
            yield at, text[at:m.start()], False
            yield m.start(), m.group(), True
            at = m.end()
        yield at, text[at:], False

    def words(self, segment: str) -> list[str]:
        if not _PLAIN.search(segment):
            return (_SPLIT_ASCII if segment.isascii() else _SPLIT).findall(segment.lower())
        plain = self.library.normalizer.normalize_str(segment)
        back = {c: b for b, c in enumerate(self.alphabet)}
        return [bytes(back[c] for c in w).decode(errors="replace")
                for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.cut is None or not self.cut.search(text):
            return self._sum(text)
        return sum(1 if special else self._sum(s) for _, s, special in self._segments(text) if s)

    def _sum(self, segment: str) -> int:
        return sum(map(self.known.__getitem__, self.words(segment)))

    def spans(self, text: str) -> Iterator[tuple[int, int, str | None]]:
        """(start, end, word or None for a special string) in code points of the text."""
        for at, segment, special in self._segments(text):
            if special:
                yield at, at + len(segment), None
            elif _PLAIN.search(segment) or len(segment.lower()) != len(segment):
                # where normalizing moves characters, the library's own offsets lead back to the text
                e = self.library.encode(segment, add_special_tokens=False)
                merged: dict[int, list[int]] = {}
                for w, (a, b) in zip(e.word_ids, e.offsets, strict=True):
                    got = merged.setdefault(w, [a, b])
                    got[0], got[1] = min(got[0], a), max(got[1], b)
                for w, (a, b) in zip(self.words(segment), (merged[k] for k in sorted(merged)), strict=True):
                    yield at + a, at + b, w
            else:
                for m in _SPLIT.finditer(segment.lower()):
                    yield at + m.start(), at + m.end(), m.group()

    def prefixes(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ends of the words (code points) and the count of the text up to each."""
        ends, counts, total = [], [], 0
        for _, end, word in self.spans(text) if text else ():
            total += 1 if word is None else self.known[word]
            ends.append(end)
            counts.append(total)
        return ends, counts

    def truncated(self, text: str, budget: int) -> str:
        """The longest prefix, not cut inside a special string, of at most ``budget`` tokens, from the tables alone."""
        total = 0
        for start, end, word in self.spans(text):
            n = 1 if word is None else self.known[word]
            if total + n > budget:
                inside = 0
                if word is not None and len(word) == end - start:
                    table, size = self.table(word, ends=True), 0
                    for k, c in enumerate(word[:-1], 1):
                        size += len(c.encode())
                        cut = table[size - 1]
                        if word[0] == "'" and k == 2:  # a contraction cut here is an apostrophe and a letter
                            cut = self.known[word[0]] + self.known[word[1]]
                        if total + cut <= budget:
                            inside = k
                return text[: start + inside]
            total += n
        return text


def counter(spec: str) -> PrefixCounter:
    """One counter a worker process and vocabulary; its tables serve all tasks of the process."""
    key = hash(spec)
    if key not in _COUNTERS:
        _COUNTERS[key] = PrefixCounter(spec)
    return _COUNTERS[key]


def _sent(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:  # a vocabulary file, of a fixed size, on the driver
        return spark.sparkContext.broadcast(f.read())


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, prefixes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every whole text.

    ``prefixes`` adds ``prefix_end`` and ``prefix_tokens``: at the end of each word the
    exact count so far (the count between two ends is that of the earlier one, and inside
    a word ``PrefixCounter.table`` has it).
    """
    spark = docs.sparkSession
    ship(spark)
    spec = _sent(spark, path)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(spec.value)
        for b in batches:
            n, ends, counts = [], [], []
            for t in b.column("text"):
                t = t.as_py()
                if prefixes:
                    e, k = c.prefixes(t)
                    ends.append(e)
                    counts.append(k)
                    n.append(k[-1] if k else 0)
                else:
                    n.append(c.count(t))
            cols = [b.column("doc_id"), b.column("n_bytes"), pa.array(n, type=pa.int64()),
                    pa.array(np.asarray(n, dtype=np.int64) > limit)]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            if prefixes:
                cols += [pa.array(ends, type=pa.list_(pa.int32())), pa.array(counts, type=pa.list_(pa.int32()))]
                names += ["prefix_end", "prefix_tokens"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean" + (
        ", prefix_end array<int>, prefix_tokens array<int>" if prefixes else "")
    text = F.col("text").cast("string")
    return docs.select("doc_id", text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
                       ).mapInArrow(counted, schema)


def tokens_at(ends: list[int], counts: list[int], position: int) -> int:
    """Tokens of the whole words that end at or before a position, from a stored table."""
    i = bisect_right(ends, position)
    return counts[i - 1] if i else 0
