"""Secret scans: fixed patterns, and automata inferred from what those find."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .automata import Automaton
from .common import fresh, stored

# The base patterns, in the order kinds are listed.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
# Runs shorter than the least length fail anyway, so the length is part of the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "format"]
# What may be a credential by its format, whole or between separators; the shortest value that assign labels.
SHORTEST = 6
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)
_PIECE = re.compile(r"[^=/.]+")
# One of these stands in every match of assign, in either case.
_NAMES = ["passw", "secret", "token", "key"]
# Runs remembered as holding no credential, and the longest of them: at most about 20 MB a task.
REMEMBERED = 100_000
REMEMBERED_LENGTH = 64
_CLASSES = str.maketrans(
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0" * 10 + "a" * 6 + "g" * 20 + "A" * 6 + "G" * 20
)
SYMBOLS = "0agAG+/_.=-"

# Bounds of the labelled sample the automata are fitted on: distinct formats of each kind, and their longest.
LABELLED_FORMATS = 2000
LABELLED_LENGTH = 256

Span = tuple[str, int, int]


def base_spans(text: str, runs: list[str] | None = None) -> list[Span]:
    """Matches of the fixed patterns: leftmost, not overlapping within a kind, of the least length; in code points.

    What a match must hold is looked for first, as most texts hold none of it.
    ``runs``: all candidate runs of the text, if they are known.
    """
    found: list[Span] = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(name in low for name in _NAMES):
            found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    # Hexadecimal digits in a row are part of a candidate run at least as long.
    if runs is None or max(map(len, runs), default=0) >= 24:
        found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in _ordered(spans))


def _runs(text: str, base: list[Span]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Candidates of the shortest length on, and what base spans leave of each."""
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    at = 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        left, start = [], a
        for x, y in taken[at:]:
            if x >= b:
                break
            if x > start:
                left.append((start, x))
            start = max(start, y)
        if start < b:
            left.append((start, b))
        yield a, b, left


def _others(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Candidates that no base span touches."""
    for a, b, left in _runs(text, base):
        if left == [(a, b)]:
            yield a, b


class Formats:
    """Automata of credential formats, and symbol pairs of all other tokens to hold them against."""

    def __init__(self, examples: dict[str, dict[str, int]], pairs: dict[str, int], least_bits: float):
        self.automata = [Automaton(e, SYMBOLS) for _, e in sorted(examples.items()) if e]
        self.least_bits = least_bits
        self.shortest = min((len(f) for e in examples.values() for f in e), default=SHORTEST)
        self.known: dict[str, bool] = {}
        self.plain: set[str] = set()
        after = Counter()
        for pair, n in pairs.items():
            after[pair[0]] += n
        kinds = len(SYMBOLS) + 1
        self.pairs = {p: math.log2((n + 1) / (after[p[0]] + kinds)) for p, n in pairs.items()}
        self.unseen = {c: math.log2(1 / (after[c] + kinds)) for c in "^" + SYMBOLS}

    def background(self, form: str) -> float:
        return sum(self.pairs.get(a + b, self.unseen[a]) for a, b in zip("^" + form, form + "$"))

    def accepts(self, token: str) -> bool:
        """Some automaton gives it the likelihood of its own examples, and far more than ordinary tokens have."""
        if len(token) < self.shortest:
            return False
        form = token.translate(_CLASSES)
        if form not in self.known:
            if len(self.known) >= 100_000:
                self.known.clear()
            self.known[form] = self._accepts(form)
        return self.known[form]

    def _accepts(self, form: str) -> bool:
        ordinary = None
        for automaton in self.automata:
            if automaton.typical(form):
                ordinary = self.background(form) if ordinary is None else ordinary
                if automaton.score(form) - ordinary >= self.least_bits:
                    return True
        return False

    def found(self, text: str, base: list[Span], runs: list[str] | None = None) -> Iterator[tuple[int, int]]:
        """Accepted runs, else what is accepted of them: rests beside base spans, values behind a name, pieces.

        What a run holds that no base span touches depends on the run alone, so
        runs that hold nothing are remembered. ``runs``: all runs of the text.
        """
        if not base and runs is not None and not any([self._holds(run) for run in set(runs) - self.plain]):
            return
        for a, b, left in _runs(text, base):
            run = text[a:b] if left == [(a, b)] else None
            if run in self.plain:
                continue
            yield from self._inside(text, a, b, left)

    def _holds(self, run: str) -> bool:
        if any(self._inside(run, 0, len(run), [(0, len(run))])):
            return True
        if len(run) <= REMEMBERED_LENGTH:
            if len(self.plain) >= REMEMBERED:
                self.plain.clear()
            self.plain.add(run)
        return False

    def _inside(self, text: str, a: int, b: int, left: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        if left and self.accepts(text[a:b]):
            yield a, b
            return
        for x, y in left:
            if (x, y) != (a, b) and self.accepts(text[x:y]):
                yield x, y
                continue
            value = text.find("=", x, y) + 1
            if value and self.accepts(text[value:y]):
                yield value, y
                y = value
            for m in _PIECE.finditer(text, x, y):
                if m.span() != (a, b) and self.accepts(m[0]):
                    yield m.span()


def _formats_of(tokens: Counter, forms: Counter) -> None:
    """Count distinct tokens under their formats, and empty their list."""
    for token, n in tokens.items():
        forms[token.translate(_CLASSES)] += n
    tokens.clear()


def infer_formats(
    docs: DataFrame, labelled_formats: int = LABELLED_FORMATS, labelled_length: int = LABELLED_LENGTH, least_bits: float = 16.0,
) -> Formats:
    """Automata fitted on credentials that the base patterns label, one for each kind.

    The labelled sample has at most ``labelled_formats`` formats of a kind, those
    of the smallest hashes, no longer than ``labelled_length``. Pairs of symbols
    in ordinary tokens are counted over all texts (at most 12 x 12 rows).
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms: Counter = Counter()
            ordinary: Counter = Counter()
            tokens: Counter = Counter()
            for text in batch.column("text"):
                text = text.as_py() or ""
                runs = _CANDIDATE.findall(text)
                base = base_spans(text, runs)
                for kind, a, b in base:
                    value = text[a:b] if kind != "assign" else _ASSIGN.match(text, a)[2]
                    if len(value) <= labelled_length:
                        forms[kind, value.translate(_CLASSES)] += 1
                tokens.update([text[a:b] for a, b in _others(text, base)] if base else runs)
                if len(tokens) >= REMEMBERED:
                    _formats_of(tokens, ordinary)
            _formats_of(tokens, ordinary)
            for form, n in ordinary.items():
                for x, y in zip("^" + form, form + "$"):
                    forms["pair", x + y] += n
            kinds, values = zip(*forms) if forms else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(list(forms.values()), pa.int64())],
                ["kind", "form", "n"],
            )

    counted = docs.select("text").mapInArrow(rows, "kind string, form string, n long")
    counted = stored(counted.groupBy("kind", "form").agg(F.sum("n").alias("n")), "formats")
    pairs = {r["form"]: r["n"] for r in counted.filter("kind = 'pair'").collect()}  # at most 12 x 12
    examples = {
        kind: {r["form"]: r["n"] for r in counted.filter(F.col("kind") == kind).orderBy(F.xxhash64("form"), "form")
               .limit(labelled_formats).collect()}
        for kind in KINDS[:3]
    }
    return Formats(examples, pairs, least_bits)


def spans_of(text: str, formats: Formats) -> tuple[list[Span], list[Span]]:
    runs = _CANDIDATE.findall(text)
    base = base_spans(text, runs)
    return base, base + [("format", a, b) for a, b in formats.found(text, base, runs)]


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every document.

    Base spans are kept whatever the automata say. Tokens from the shortest
    labelled length on are added where they have the format of a credential,
    as a whole, in what base spans leave of them, or in a piece between = / .
    A null text is the empty text. Null and repeated doc_ids
    and repeated rows keep their rows. Other columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column("text"):
                base, spans = spans_of(text.as_py() or "", formats)
                kinds = Counter(k for k, _, _ in base)
                row = (*(kinds[k] for k in KINDS[:3]), hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans))
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(text: Column, formats: Formats, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans count as one. Null stays null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            text = text.as_py()
            if text:
                parts, at = [], 0
                for _, a, b in sorted(spans_of(text, formats)[1], key=lambda s: (s[1], s[2])):
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    return cut(text)


def redact(docs: DataFrame, formats: Formats, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets replaced in text, and n_chars, where there is such a column, counted again."""
    held = fresh(docs, "redacted")
    marked = docs.withColumn(held, redacted(F.col("text"), formats, mark))
    columns = {"text": F.col(held)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(held) == F.col("text"), F.col("n_chars")).otherwise(
            F.length(held).cast(docs.schema["n_chars"].dataType)
        )
    return marked.withColumns(columns).select(*docs.columns)
