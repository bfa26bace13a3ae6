"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised benchmark items go into one automaton (words are its letters). Document words stream through it;
at each word it knows the longest match that ends there. Where that reaches the window, the last
``WINDOW`` words stand in some item, and all of them are hit; an item shorter than the window is one
window of its own, found at the states of which it is a suffix.

Benchmark items are cut into blocks of ``BLOCK_WORDS`` words, one automaton each; whole items go to a
block, and a task holds the automata of all blocks. The result does not depend on the cut: what the blocks find in a text is united
before anything is decided. Documents are read in a stream, row by row.

Defined cases: null and empty texts have no words, no hits and stay; an item without words never
occurs; a null ``item_id`` counts as an item but has no id to report; repeated items and rows each count
for themselves; empty tables give no hits or an empty result; input columns named like an added one are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from transitlake.llm.common import by_batch, table, text_pieces

WINDOW = 10
BLOCK_WORDS = 200_000
# Share of hit words at which a document goes as a whole.
COVERAGE = 0.5

# The words of the contract, on UTF-8: digits, a to z, and all bytes of characters above ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Automaton:
    """Suffix automaton of many word sequences, with the items that hold each window."""

    def __init__(self, items: Iterable[tuple[int, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ids: dict[bytes, int] = {}
        numbered = []
        for item, words in items:
            letters = [self.ids.setdefault(w, len(self.ids)) for w in words]
            if letters:
                numbered.append((item, letters))
                last = 0
                for letter in letters:
                    last = self._append(last, letter)
        # Items of a window, at the state that stands for it; items that are shorter, with their length.
        self.windows: dict[int, set[int]] = {}
        self.shorter: dict[int, list[tuple[int, int]]] = {}
        for item, letters in numbered:
            state = 0
            for n, letter in enumerate(letters, 1):
                state = self.next[state][letter]
                while self.length[self.link[state]] >= window:
                    state = self.link[state]
                if n >= window:
                    self.windows.setdefault(state, set()).add(item)
            if len(letters) < window:
                self.shorter.setdefault(state, []).append((len(letters), item))
        # Short items are also suffixes of the matches below them in the tree of links.
        self.endings: dict[int, list[tuple[int, int]]] = {}
        if self.shorter:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                found = self.shorter.get(state, []) + self.endings.get(self.link[state], [])
                if found:
                    self.endings[state] = found

    def _append(self, last: int, letter: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        if letter in nexts[last]:
            q = nexts[last][letter]
            return q if length[q] == length[last] + 1 else self._split(last, letter, q)
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and letter not in nexts[p]:
            nexts[p][letter] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][letter]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, letter, q)
        return new

    def _split(self, p: int, letter: int, q: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(dict(nexts[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nexts[p].get(letter) == q:
            nexts[p][letter] = copy
            p = link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Hit stretches (first word, word after the last), items found, longest match."""
        nexts, link, length, window, get = self.next, self.link, self.length, self.window, self.ids.get
        windows, endings = self.windows, self.endings
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state = matched = longest = 0
        for at, word in enumerate(words):
            letter = get(word)
            if letter is None:
                state = matched = 0
                continue
            while state and letter not in nexts[state]:
                state = link[state]
                matched = length[state]
            state = nexts[state].get(letter, 0)
            if not state:
                matched = 0
                continue
            matched += 1
            if matched > longest:
                longest = matched
            reach = 0
            if matched >= window:
                holder = state
                while length[link[holder]] >= window:
                    holder = link[holder]
                items |= windows[holder]
                reach = window
            for size, item in endings.get(state, ()):
                if size <= matched:
                    items.add(item)
                    reach = max(reach, size)
            if reach:
                begin = at + 1 - reach
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, at + 1))
        return spans, items, longest


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall((text or b"").lower())


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[list[tuple[int, str | None, list[bytes]]]]:
    """Items as (number, id, words), read one after the other and cut into blocks."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("binary").alias("t"))
    blocks: list[list] = [[]]
    size = 0
    for n, row in enumerate(rows.toLocalIterator()):
        words = words_of(None if row.t is None else bytes(row.t))
        if size and size + len(words) > block_words:
            blocks.append([])
            size = 0
        size += len(words)
        blocks[-1].append((n, row.i, words))
    return blocks


HITS = T.StructType(
    [
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("n_items", T.LongType()),
        T.StructField("longest", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)
_HITS = pa.struct(
    [
        ("spans", pa.list_(pa.list_(pa.int32()))),
        ("items", pa.list_(pa.string())),
        ("n_items", pa.int64()),
        ("longest", pa.int64()),
        ("n_words", pa.int64()),
    ]
)


def _scanner(block: list, name: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(((n, words) for n, _, words in block), window)
        ids = {n: i for n, i, _ in block}
        for batch in text_pieces(batches):
            out = []
            for text in batch.column("__text").to_pylist():
                words = words_of(text)
                spans, items, longest = automaton.scan(words)
                out.append(
                    {
                        "spans": spans,
                        "items": [ids[i] for i in items if ids[i] is not None],
                        "n_items": len(items),
                        "longest": longest,
                        "n_words": len(words),
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, _HITS)], names=[*batch.schema.names, name]
            )

    return run


def scanned(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``__text`` (UTF-8) and ``__hits``, one entry per block of items."""
    df = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("binary").alias("__text"))
    blocks = item_blocks(benchmark)
    for n, block in enumerate(blocks):
        schema = T.StructType([*df.schema.fields, T.StructField(f"__hits{n}", HITS)])
        df = df.mapInArrow(_scanner(block, f"__hits{n}", window), schema)
    return df.select(*[F.col(f"`{c}`") for c in keep], "__text", F.array(*[f"__hits{n}" for n in range(len(blocks))]).alias("__hits"))


def _merge(spans: Iterable[Iterable[int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(map(tuple, spans)):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


_REPORT = "n_words long, n_hit long, n_items long, items_sha256 string, longest_match long, contaminated boolean"


def _report(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for hits in batch.column("__hits").to_pylist():
        spans = _merge(s for h in hits for s in h["spans"])
        ids = sorted(i for h in hits for i in h["items"])
        n_hit = sum(end - begin for begin, end in spans)
        rows.append(
            (
                hits[0]["n_words"],
                n_hit,
                sum(h["n_items"] for h in hits),
                hashlib.sha256(",".join(ids).encode()).hexdigest(),
                max(h["longest"] for h in hits),
                n_hit > 0,
            )
        )
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    names = [part.split()[0] for part in _REPORT.split(", ")]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: its words, the words hit, the items found."""
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    found = scanned(docs.select("doc_id", "text"), benchmark, ["doc_id"], window).drop("__text")
    return found.mapInArrow(by_batch(_report), f"doc_id {kind}, {_REPORT}")


def _cleaner(blocks: list[list], window: int, coverage: float):
    """Texts without the words that any block hits; rows that are mostly benchmark are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [Automaton(((n, words) for n, _, words in block), window) for block in blocks]
        for batch in text_pieces(batches):
            texts, keep, counts = [], [], []
            for text in batch.column("text").to_pylist():
                raw = None if text is None else text.encode()
                kept, touched, found = raw, False, raw is not None
                # Taking a span out brings its neighbours together, so look again until nothing is found.
                while found:
                    places = [m.span() for m in WORD.finditer(kept.lower())]
                    lowered = kept.lower()
                    words = [lowered[b:e] for b, e in places]
                    spans = _merge(span for automaton in automata for span in automaton.scan(words)[0])
                    found = bool(spans)
                    if found:
                        hit = sum(end - begin for begin, end in spans)
                        if hit >= coverage * len(places):
                            kept = None
                            break
                        touched = True
                        parts, at = [], 0
                        for begin, end in spans:
                            parts.append(kept[at : places[begin][0]])
                            at = places[end - 1][1]
                        kept = b"\n".join([*parts, kept[at:]])
                keep.append(raw is None or kept is not None)
                texts.append(kept.decode() if touched and kept is not None else text)
                counts.append(len(texts[-1]) if touched and kept is not None else None)
            columns = []
            for name, column in zip(batch.schema.names, batch.columns):
                if name == "text":
                    column = pa.array(texts, batch.schema.field("text").type)
                elif name == "n_chars":
                    old = column.to_pylist()
                    column = pa.array([o if c is None else c for o, c in zip(old, counts)], column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(keep, pa.bool_()))

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the words that stand in a window of an item; ``n_chars`` follows a changed text.

    A document of which ``coverage`` or more of the words are hit goes as a whole; a clean one stays as it is.
    """
    return docs.mapInArrow(_cleaner(item_blocks(benchmark, block_words), window, coverage), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op10_suffix_automaton``."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match")
