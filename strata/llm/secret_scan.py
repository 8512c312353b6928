"""Secret scans: rule matches plus sliding-window Shannon entropy.

``secret_spans`` returns per document its list of spans (kind, start, end in
code points, end exclusive).  Three kinds come from fixed rules; kind
``entropy`` comes from the method: inside each candidate string the text is cut
into maximal runs of one character class, a window slides over the run, and its
entropy is kept up to date by adding one character and removing one
(``sum c*log2 c`` changes by a table difference).  Windows above the threshold
of their class merge into one span.  The allow list suppresses candidates that
are known to be harmless; it never touches the rule spans, and an entropy span
inside a rule span is not reported twice.

Edge cases: null or empty text has no spans; repeated rows are scanned one by
one; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep_columns, slices

KINDS = ("assign", "access", "hex", "entropy")

# The rule patterns and their least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run starts where it is first met, so the length can be asked for here
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20


@dataclass(frozen=True)
class CharClass:
    run: re.Pattern
    threshold: float  # bits per character over one window
    needs: tuple[re.Pattern, ...]  # each must occur in the window
    slugs: bool = True  # whether strings that look like slugs count


CLASSES = (
    CharClass(re.compile(r"[0-9A-Fa-f]{20,}"), 2.8, (re.compile("[0-9]"), re.compile("[A-Fa-f]"))),
    CharClass(re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.7, (re.compile("[0-9]"), re.compile("[A-Z]"), re.compile("[a-z]"))),
    # one case: digits must stand among the letters, as a word with a number behind it does not
    CharClass(re.compile(r"[0-9a-z]{20,}"), 3.5, (re.compile("[0-9][a-z]+[0-9]"), re.compile("(?:[0-9][a-z]*){3}")), False),
    CharClass(re.compile(r"[0-9A-Z]{20,}"), 3.5, (re.compile("[0-9][A-Z]"), re.compile("[G-Z]")), False),
    # no digits: the case must change more often than between joined words
    CharClass(re.compile(r"[A-Za-z]{20,}"), 3.7, (re.compile("(?:[a-z][A-Z][A-Za-z]*?){4}"),), False),
)

#: candidates that are never secrets: placeholders, one repeated pattern, paths
ALLOW = (
    re.compile(r"(?i)example|placeholder|changeme|your[-_]|dummy|lorem"),
    re.compile(r"^(.{1,8}?)\1+.{0,8}$"),
    re.compile(r"^(?:/[A-Za-z0-9_-]*[a-z]{3,}[A-Za-z0-9_-]*){2,}/?$"),
)

#: words and slugs, numbered or not; no such candidate is a key of one case or without digits
SLUG = re.compile(r"^(?:[A-Z]?[a-z]{3,}+[0-9]{0,4}+[/_=-]*+)++$|^(?:[A-Z]{3,}+[0-9]{0,4}+(?:[/_=-]++|$))++$")

_CLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
_LOG_W = math.log2(WINDOW)

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def hot_windows(run: str, threshold: float) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows whose entropy reaches the threshold."""
    least = (_LOG_W - threshold) * WINDOW  # entropy = log2 W - sum(c log2 c)/W
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += _CLOG[c + 1] - _CLOG[c]
        if i >= WINDOW:
            old = run[i - WINDOW]
            c = counts[old]
            counts[old] = c - 1
            total += _CLOG[c - 1] - _CLOG[c]
        if i >= WINDOW - 1 and total <= least + 1e-9:
            lo = i - WINDOW + 1
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((lo, i + 1))
    return out


def entropy_spans(text: str) -> list[tuple[str, int, int]]:
    found: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        word = m.group()
        if word.islower() and word.isalpha() or any(a.search(word) for a in ALLOW):
            continue
        slug = SLUG.match(word)
        for cls in CLASSES:
            if slug and not cls.slugs:
                continue
            for r in cls.run.finditer(word):
                for lo, hi in hot_windows(r.group(), cls.threshold):
                    if all(need.search(r.group(), lo, hi) for need in cls.needs):
                        found.append((m.start() + r.start() + lo, m.start() + r.start() + hi))
    found.sort()
    merged: list[list[int]] = []
    for lo, hi in found:
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return [("entropy", lo, hi) for lo, hi in merged]


def scan(text: str | None) -> list[tuple[str, int, int]]:
    if not text:
        return []
    rules = rule_spans(text)
    extra = [s for s in entropy_spans(text) if not any(r[1] <= s[1] and s[2] <= r[2] for r in rules)]
    return sorted(rules + extra, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and all spans of each document, by start, then kind."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [[dict(zip(("kind", "start", "end"), s)) for s in scan(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(found, pa.list_(SPAN))], names=["doc_id", "spans"])

    return keep_columns(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def redact(text: str | None, mark: str = "[REDACTED]") -> str | None:
    spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for _, lo, hi in sorted(spans, key=lambda s: s[1]):
        if lo >= at:
            out += [text[at:lo], mark]
        at = max(at, hi)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with every secret span replaced; all columns stay, and
    ``n_chars`` (where present) follows the new text."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                at = part.schema.get_field_index("text")
                text = pa.array([redact(t) for t in part.column("text").to_pylist()], part.schema.field(at).type)
                columns = list(part.columns)
                columns[at] = text
                n = part.schema.get_field_index("n_chars")
                if n >= 0:
                    columns[n] = pc.utf8_length(text).cast(part.schema.field(n).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The counted and joined form of ``secret_spans``."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(of(*KINDS[:3])).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
