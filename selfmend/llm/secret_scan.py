"""Secret scans: fixed key patterns plus sliding-window entropy.

The base kinds are regular expressions (``assign``, ``access``, ``hex``),
leftmost and non-overlapping per kind. The method adds spans of kind
``entropy``: candidate strings are runs of key characters; for each character
class a window slides over the candidate's maximal runs of that class, the
window's Shannon entropy is kept up to date by the counts of the character
that enters and the one that leaves, and the windows at or above the class's
threshold are joined into spans. Spans that an allow-list pattern accounts
for, or that lie inside a base span, are left out; base spans always stay.

Positions are code points, the end exclusive. Defined cases: a NULL or empty
text has no span; every row is scanned on its own, repeated rows alike; other
columns are never read. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import map_arrow, text_column, text_slices, with_text

#: Spans are listed by start, then in this order of kinds.
KINDS = ("assign", "access", "hex", "entropy")
# fixed values: the base patterns and the least lengths
_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24


@dataclass(frozen=True)
class CharClass:
    """Windows of ``window`` characters of one class count as random from
    ``threshold`` bits a character on."""
    name: str
    chars: str
    window: int
    threshold: float


CLASSES = (
    CharClass("hex", "0123456789abcdefABCDEF", 24, 3.0),
    CharClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 20, 3.75),
)
#: A candidate holds a digit and a letter, and is at least this long.
CANDIDATE_LENGTH = 20
_CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
_RUNS = {c.name: re.compile(f"[{re.escape(c.chars)}]{{{c.window},}}") for c in CLASSES}

#: Candidates that match one of these as a whole are known not to be secrets.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",     # UUID
    r"(?:[A-Za-z]+[-_/])+[A-Za-z]+\d{0,4}",                # words joined by marks, paths
    r"[\d/_=+-]+",                                         # dates, numbers, rules
)
#: An integrity digest, as long as its kind is, or the token after its name. What follows it is looked at.
DIGEST = (r"(?:md5[-=](?:[0-9a-fA-F]{32}|[A-Za-z0-9+/]{22}==)|sha1[-=](?:[0-9a-fA-F]{40}|[A-Za-z0-9+/]{27}=)"
          r"|sha256[-=](?:[0-9a-fA-F]{64}|[A-Za-z0-9+/]{43}=)|sha384[-=](?:[0-9a-fA-F]{96}|[A-Za-z0-9+/]{64})"
          r"|sha512[-=](?:[0-9a-fA-F]{128}|[A-Za-z0-9+/]{86}==)|(?:sha(?:1|256|384|512)|md5)[-=][A-Za-z0-9+_-]*=*)")
#: Words that say that the token they stand in is none; a token ends at a slash or an equals sign.
_NO_SECRET = re.compile(r"(?i)example|placeholder|dummy|changeme|your[-_]?")
_TOKEN = re.compile(r"[A-Za-z0-9+_-]*")
_KEY_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+_-")
#: Addresses. What stands in a URL is looked at by its parts, an e-mail address not at all. A URL ends at the first character that does not stand in one unquoted (white space, quotes, commas, semicolons,
#: brackets, a backslash and the like), an e-mail address with the host behind the '@'.
_ADDRESS = re.compile(r"(?:https?://|www\.)[A-Za-z0-9_.~:/?#@!$&*+=%-]*|@[A-Za-z0-9.-]*")
_PART = re.compile(r"[A-Za-z0-9+_-]{20,}")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_VALUE]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return found


def random_windows(run: str, window: int, threshold: float) -> list[tuple[int, int]]:
    """The stretches of ``run`` covered by windows of at least ``threshold``
    bits a character. With counts c, a window's entropy is
    ``log2(window) - sum(c log2 c) / window``; a step changes two counts."""
    weigh = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    most = (math.log2(window) - threshold) * window + 1e-9
    counts: dict[str, int] = {}
    total = 0.0
    out: list[tuple[int, int]] = []
    for i, char in enumerate(run):
        c = counts.get(char, 0)
        total += weigh[c + 1] - weigh[c] if c < window else 0.0
        counts[char] = c + 1
        if i >= window:
            gone = run[i - window]
            c = counts[gone]
            counts[gone] = c - 1
            total += weigh[c - 1] - weigh[min(c, window)]
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def _mixed(word: str) -> bool:
    return not word.isalpha() and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def _pieces(text: str, start: int, end: int, addresses: list[tuple[int, int]], begins: list[int]):
    """What is looked at of the candidate ``text[start:end]``: its stretches
    outside addresses, and of those in a URL the parts between slashes and
    equals signs."""
    last = bisect_right(begins, start) - 1
    if last >= 0 and addresses[last][1] <= start:
        last += 1
    last = max(last, 0)
    while start < end:
        a, b = addresses[last] if last < len(addresses) else (end, end)
        if a > start:
            yield start, min(a, end)
        elif text[a] != "@":
            for m in _PART.finditer(text, start, min(b, end)):
                yield m.span()
        start = a if a > start else b
        last += a <= start and b <= start


def entropy_spans(text: str, base: list[tuple[str, int, int]], classes=CLASSES, allowed=None) -> list[tuple[str, int, int]]:
    """The added spans. Overlapping spans of different classes are joined."""
    allowed = _ALLOWED if allowed is None else allowed
    out: list[tuple[int, int]] = []
    addresses = begins = None           # looked for with the first candidate that needs them
    for m in _CANDIDATE.finditer(text):
        if not _mixed(m[0]):
            continue
        if addresses is None:
            addresses = [a.span() for a in _ADDRESS.finditer(text)]
            begins = [a for a, _ in addresses]
        for start, end in _pieces(text, m.start(), m.end(), addresses, begins):
            word = text[start:end]
            if len(word) < CANDIDATE_LENGTH or not _mixed(word) or allowed.fullmatch(word):
                continue
            digest = _DIGEST.match(word)
            if digest:
                start, word = start + digest.end(), word[digest.end():]
            for cls in classes:
                for run in _RUNS[cls.name].finditer(word):
                    if any(c.isdigit() for c in run[0]):
                        at = start + run.start()
                        out += [(at + a, at + b) for a, b in random_windows(run[0], cls.window, cls.threshold)]
    joined: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    left = [x for a, b in joined for x in _without_placeholders(text, a, b)]
    return [("entropy", a, b) for a, b in left if not any(x <= a and b <= y for _, x, y in base)]


def _without_placeholders(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """The span, or, if some of its tokens say that they are no secrets, the
    others of them that are long enough for one."""
    first = a
    while first and text[first - 1] in _KEY_CHARS:
        first -= 1
    end = _TOKEN.match(text, b).end()
    if not _NO_SECRET.search(text, first, end):
        return [(a, b)]
    tokens = [m.span() for m in _TOKEN.finditer(text, first, end) if m[0] and not _NO_SECRET.search(m[0])]
    return [(max(x, a), min(y, b)) for x, y in tokens if min(y, b) - max(x, a) >= CANDIDATE_LENGTH]


_DIGEST = re.compile(DIGEST)
_ALLOWED = re.compile("|".join(f"(?:{x})" for x in ALLOWED), re.S)


def scan(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans and all spans of a text, by start, then kind."""
    if not text:
        return [], []
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = base_spans(text)
    return sorted(base, key=order), sorted(base + entropy_spans(text, base), key=order)


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


def scan_documents(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    def run(batches):
        for part in text_slices(batches):
            rows = []
            for text in part.column("text").to_pylist():
                base, spans = scan(text)
                kinds = [k for k, _, _ in base]
                rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                             hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(spans)))
            n_assign, n_access, n_hex, digest, spans = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_assign, pa.int64()), pa.array(n_access, pa.int64()),
                 pa.array(n_hex, pa.int64()), pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", "text"), run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(text: str | None, mask: str = "<SECRET>") -> str | None:
    """The text with each stretch covered by spans replaced by ``mask``."""
    _, spans = scan(text)
    if not spans:
        return text
    out, end = [], 0
    for _, a, b in spans:
        if a >= end:
            out += [text[end:a], mask]
        end = max(end, b)
    return "".join([*out, text[end:]])


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked and ``n_chars`` brought up
    to date; all rows and columns stay."""
    def run(part):
        return pa.array([masked(x) for x in part.column("text").to_pylist()], pa.string())

    return with_text(docs, text_column(docs.sparkSession, run, "string", F.col("text"))).select(*docs.columns)
