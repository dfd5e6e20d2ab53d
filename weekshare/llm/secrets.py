"""Secret scans (operator 1).

Two layers over each whole text:

* Base patterns: ``assign``, ``access`` and ``hex`` (below). They always stay.
* Entropy: candidate strings (long runs of key characters) are read with a
  sliding window. The window keeps counts per character and the sum of
  ``c * log2 c``; moving it by one character changes two counts, so each step
  costs the same whatever the window. A window belongs to the narrowest
  character class that holds it (hex, alphanumeric, all key characters) and
  is flagged when its Shannon entropy reaches that class's threshold;
  overlapping flagged windows merge and widen to the whole runs of key
  characters they touch (a padding ``=`` ends a run), since the ends of a key
  can lack digits; each is one ``entropy`` span. Allow-listed candidates
  (UUIDs, words, numbers) and spans that only repeat a base span are dropped.
  In a lower-case path each segment is judged alone: those of words and
  numbers are spared, the others are spans where flagged windows touch them.

Per-text work in one map over the scan: no shuffle, memory bounded by a batch.

Defined cases: null and empty texts have no spans; null ids are kept; repeated
rows are scanned each; other columns are ignored (``scan_secrets``) or kept
(``redact_secrets``).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import plain_texts, read_table, text_batches

# Kinds in report order and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 6
# "AKIA[A-Z0-9]+ of 20 characters or more" and "[0-9a-f]+ of 24 or more": both
# runs are maximal, so the length can be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# Entropy layer: window, candidates, and bits per character class.
WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
HEX_CHARS = frozenset("0123456789abcdefABCDEF")
THRESHOLDS = {"hex": 3.0, "alnum": 3.6, "key": 3.8}
# Allow-list: candidates and path segments that look random but are not secrets.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"),   # UUID
    re.compile(r"[A-Za-z]+"),                                             # a word
    re.compile(r"[0-9_=+/-]+"),                                           # numbers, rules
    re.compile(r"[A-Za-z]+(?:[-_/=][A-Za-z]+)+"),                         # joined words
)
# A path, three letters together in its first part. No run inside a repeated
# run, so each character is read a fixed number of times.
PATH = re.compile(r"/?(?=[a-z0-9_-]*[a-z]{3})[a-z0-9_-]+(?:/[a-z0-9_-]+)+/?")
SEGMENT = re.compile(r"[a-z0-9_-]+")
# Words and numbers between - and _: "utf8", "k8s", "1920x1080", not "n7x2k9".
PIECE = re.compile(r"[a-z0-9]+")
# Possessive, as each run ends at the other kind: a long piece is read twice at most.
PLAIN_PIECE = re.compile(r"[a-z]*+[0-9]*+[a-z]*+|[0-9]++[a-z]++[0-9]++")
RUN = re.compile(r"[^=]+=*|=+")

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
          "spans string, n_entropy long")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base patterns, by start then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if m.end(1) - m.start(1) >= ASSIGN_MIN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _class_of(letters: int, digits: int, nonhex: int, marks: int) -> str | None:
    if not letters or not digits:
        return None                      # one class alone is a word or a number
    if marks:
        return "key"
    return "alnum" if nonhex else "hex"


def entropy_windows(s: str, window: int = WINDOW, thresholds=None) -> list[tuple[int, int]]:
    """Flagged spans of ``s``: merged windows whose entropy reaches the threshold."""
    thresholds = thresholds or THRESHOLDS
    if len(s) < window:
        return []
    clog = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]   # one enters before one leaves
    top = math.log2(window)
    counts: dict[str, int] = {}
    total = 0.0                                    # sum of c * log2 c
    letters = digits = nonhex = marks = 0
    spans: list[tuple[int, int]] = []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += clog[c + 1] - clog[c]
        counts[ch] = c + 1
        letters += ch.isalpha()
        digits += ch.isdigit()
        nonhex += ch not in HEX_CHARS
        marks += not ch.isalnum()
        if i >= window:
            old = s[i - window]
            c = counts[old]
            total += clog[c - 1] - clog[c]
            counts[old] = c - 1
            letters -= old.isalpha()
            digits -= old.isdigit()
            nonhex -= old not in HEX_CHARS
            marks -= not old.isalnum()
        if i >= window - 1:
            kind = _class_of(letters, digits, nonhex, marks)
            if kind and top - total / window >= thresholds[kind] - 1e-9:
                start = i - window + 1
                if spans and spans[-1][1] >= start:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((start, i + 1))
    return spans


def allowed(s: str) -> bool:
    return any(p.fullmatch(s) for p in ALLOWED)


def plain_segment(s: str) -> bool:
    """Whether a path segment is a UUID or made of words and numbers."""
    return allowed(s) or all(PLAIN_PIECE.fullmatch(p) and not entropy_windows(p)
                             for p in PIECE.findall(s))


def key_spans(s: str) -> list[tuple[int, int]]:
    """Spans of the candidate ``s`` that may hold a key: what flagged windows touch."""
    flagged = [] if allowed(s) else entropy_windows(s)
    if not flagged:
        return []
    path = PATH.fullmatch(s)
    runs = [m.span() for m in (SEGMENT if path else RUN).finditer(s)
            if not path or not plain_segment(m.group())]
    spans: list[tuple[int, int]] = []
    at = 0
    for a, b in runs:                              # both lists are in order
        while at < len(flagged) and flagged[at][1] <= a:
            at += 1
        if at == len(flagged):
            break
        if flagged[at][0] < b:
            if spans and spans[-1][1] == a:
                a = spans.pop()[0]
            spans.append((a, b))
    return spans


def all_spans(text: str) -> tuple[list, list]:
    """Base spans, and base plus entropy spans."""
    base = base_spans(text)
    extra = []
    at = reach = 0                       # base spans begun so far, and their last end
    for m in CANDIDATE.finditer(text):
        for a, b in key_spans(m.group()):
            a, b = a + m.start(), b + m.start()
            while at < len(base) and base[at][0] <= a:
                reach = max(reach, base[at][2])
                at += 1
            if reach < b:                # inside no base span
                extra.append((a, 3, b))
    return base, sorted(base + extra) if extra else base


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches):
        rows = [[] for _ in range(6)]
        for text in plain_texts(batch.column("text")).to_pylist():
            base, spans = all_spans(text)
            kinds = [k for _, k, _ in spans]
            for i in range(3):
                rows[i].append(kinds.count(i))
            rows[3].append(hashlib.sha256(_join(base).encode()).hexdigest())
            rows[4].append(_join(spans))
            rows[5].append(kinds.count(3))
        long, text = pa.int64(), pa.string()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(long), *[pa.array(r, t) for r, t in
             zip(rows, (long, long, long, text, text, long))]],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its secret spans (code points, end exclusive)."""
    return (docs.selectExpr(f"CAST(`{id_col}` AS LONG) AS doc_id", f"`{text_col}` AS text")
            .mapInArrow(_scan, SCHEMA))


def redact(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every span (overlapping ones merged) replaced by ``mark``."""
    spans = all_spans(text)[1]
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        start, _, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], mark]
        at, i = end, i + 1
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced in the text and the length column renewed.

    Same rows and columns; null texts stay null. A text that needs no change
    passes as it is.
    """
    names = docs.columns
    at, width = names.index(text_col), names.index(length_col) if length_col in names else None

    def run(batches):
        for batch in text_batches(batches, text_col):
            texts = batch.column(at).to_pylist()
            done = [t if t is None else redact(t) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(done, batch.schema.field(at).type)
            if width is not None:
                kept = columns[width].to_pylist()
                columns[width] = pa.array([n if a is b or a == b else len(b) for n, a, b in
                                           zip(kept, texts, done)], batch.schema.field(width).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))
