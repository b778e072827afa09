"""Secret scan with multipart credential linking.

Strong patterns (an assignment to a secret-like name, an access identifier, a
long hexadecimal run) are reported wherever they stand.  Weak parts (an
identifier, a short or unnamed secret value, an endpoint) mean nothing alone:
an interval join within scopes links them, and a weak part is reported only
when its complement stands in the same scope: an identifier or an endpoint
needs a secret part, a weak secret needs an identifier or an endpoint.  The
scope of a part is its own interval widened by ``scope`` code points on both
sides; two parts share a scope when one's interval meets the other's scope.

Null text is the empty text: no spans.  Null doc_id stays null; repeated rows
give repeated results; offsets are code points of the whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, map_rows, sha256

# The strong kinds, in the order in which they are listed.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 18
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
RANK = {k: i for i, k in enumerate(KINDS)}

# Weak parts: names that announce an identifier or a secret, and endpoints.
NAMED = re.compile(r"(?<![A-Za-z0-9])(?:(user(?:_?(?:name|id))?|login|client_?id|account_?(?:id|name)|access_?key_?id|tenant_?id)"
                   r"|(pwd|pass(?:phrase)?|private_?key|client_?secret|access_?key|credentials?|auth_?key))"
                   r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=@-]{4,})", re.I | re.A)
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9A-Z+/_-]*[a-z])(?=[0-9a-z+/_-]*[A-Z])"
                  r"[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"\b(?:[a-z][a-z0-9+.-]*://[^\s\"'<>]+|(?:[0-9]{1,3}\.){3}[0-9]{1,3}:[0-9]{2,5}\b)", re.A)
SCOPE = 200


def strong_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def weak_parts(text: str, strong: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    found = []
    signed = ":" in text or "=" in text
    if signed:
        found += [("ident" if m[1] else "weak", *m.span()) for m in NAMED.finditer(text)]
    if ":" in text:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    if strong or found:
        # A bare value can only be linked to a part that is there already.
        found += [("weak", *m.span()) for m in BARE.finditer(text)]
    known = Intervals(strong)
    return [p for p in found if not known.meet(p[1], p[2])]


class Intervals:
    """Intervals sorted by start with running largest ends: does any meet a
    given range?  One binary search for each question."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        spans = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in spans]
        self.ends = list(accumulate((e for _, e in spans), max))

    def meet(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


def linked_spans(text: str, scope: int = SCOPE) -> tuple[list, list]:
    """(strong spans, strong and linked weak spans), by start, then kind."""
    strong = strong_spans(text)
    weak = weak_parts(text, strong)
    secrets = Intervals([p for p in strong if p[0] != "access"] + [p for p in weak if p[0] == "weak"])
    others = Intervals([p for p in strong if p[0] == "access"] + [p for p in weak if p[0] != "weak"])
    kept = [p for p in weak
            if (others if p[0] == "weak" else secrets).meet(p[1] - scope, p[2] + scope)]
    order = lambda p: (p[1], RANK[p[0]], p[2])
    return sorted(strong, key=order), sorted({*strong, *kept}, key=order)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the strong kinds, digest of their spans, and
    all spans as text (kind:start:end, comma-joined)."""
    def make():
        def row(doc, text):
            base, spans = linked_spans(text or "", scope)
            n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
            return doc, *n, sha256(joined(base).encode()), joined(spans)
        return row
    return map_rows(id_text(docs, id_col, text_col), make,
                    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, mark: str = "[secret]", scope: int = SCOPE) -> str:
    """The text with every reported span replaced by one mark (overlapping
    spans count as one)."""
    out, at = [], 0
    for _, s, e in linked_spans(text, scope)[1]:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, mark: str = "[secret]", scope: int = SCOPE, text_col: str = "text",
           chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets taken out of the text column (null stays null) and
    the length column, if there is one, counted anew for changed texts."""
    fn = F.pandas_udf(lambda s: s.map(lambda t: None if t is None else redacted(t, mark, scope)), "string")
    # The whole row travels as one struct: its column names cannot clash.
    out = docs.select(F.struct("*").alias("doc"), fn(F.col(text_col)).alias("new"))
    old, new = F.col("doc").getField(text_col), F.col("new")
    columns = {c: F.col("doc").getField(c) for c in docs.columns} | {text_col: new}
    if chars_col in docs.columns:
        columns[chars_col] = F.when(old.isNotNull() & ~new.eqNullSafe(old), F.length(new)).otherwise(
            columns[chars_col]).cast(docs.schema[chars_col].dataType)
    return out.select(*(v.alias(c) for c, v in columns.items()))
