"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in a single pass: at-signs, plus signs before digits, digits that
stand together, points before digits, schemes and words that announce an identifier. At each anchor a deterministic local
parser expands to both sides, sets the boundaries and validates what it found. Parsers look only at the run around their
anchor and never go back behind their last span, so the work is in proportion to the text.
"""

import re
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ship, unused

#: Kinds whose spans the contract fixes, and those that the method adds, in the order in which spans of one start are listed.
BASE = ("email", "ip", "card", "phone")
ADDED = ("obscured", "login", "tel", "iban", "account", "ssn", "secret")
KINDS = BASE + ADDED
#: Words that announce an identifier, by kind; each counts in lower case, in capitals and with a capital first letter.
CUES = {
    "iban": ("iban",),
    "account": ("account", "acct", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
    "secret": ("password", "passwd", "api_key", "api-key", "apikey", "secret", "token"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_DIAL = re.compile(r"[\x20().0-9-]++")
_SPELT = re.compile(r"\x20?([A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++)", re.I)
_AUTHORITY = re.compile(r"[^\x00-\x20/?#\"'<>\\]++")
_TEL = re.compile(r"\+?[0-9][0-9().-]*+")
_IBAN = re.compile(r"[\x20:=#]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"(?:\x20(?:no|nr|number|nummer))?+[.:=#\x20]{1,3}([0-9](?:[\x20-]?[0-9]){5,17})(?![0-9A-Za-z])", re.I)
_SSN = re.compile(r"(?:\x20(?:no|number))?+[.:=#\x20]{1,3}([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9])", re.I)
_SECRET = re.compile(r"\x20{0,2}[=:]\x20{0,2}(?:\"([^\"\x00-\x20]{8,})\"|'([^'\x00-\x20]{8,})'|([A-Za-z0-9_./+-]{8,}))")


def luhn(digits: str) -> bool:
    """Whether the digits' check sum is right: every second from the right is doubled, less 9 above 9."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account code's check digits are right: its first four signs go last, letters count from 10."""
    rest = 0
    for c in code[4:] + code[:4]:
        d = int(c, 36)
        rest = (rest * (100 if d > 9 else 10) + d) % 97
    return rest == 1


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _left(text: str, at: int, least: int, kind: frozenset) -> int:
    """The first place of the run of `kind` that ends before `at`, not before `least`."""
    while at > least and text[at - 1] in kind:
        at -= 1
    return at


# A parser takes the text, the anchor's first place and the place past it, and the place up to which it has looked; it
# returns the spans that it found and the place up to which it has looked now.


def _email(text: str, at: int, end: int, done: int):
    first = _left(text, at, done, _LOCAL)
    if first < at and (m := _DOMAIN.match(text, end)):
        return [(first, m.end())], m.end()
    return [], done


def _ip(text: str, at: int, end: int, done: int):
    first = _left(text, at, done, _DIGITS)
    if at < done or first == at:
        return [], done
    last, parts, found = _CHAIN.match(text, first).end(), [], []
    for m in re.compile("[0-9]++").finditer(text, first, last):
        parts.append(m)
        if len(parts) == 4:
            if all(_byte(x.group()) for x in parts):
                found.append((parts[0].start(), m.end()))
            parts = []
    return found, last


def _card(text: str, at: int, end: int, done: int):
    if at < done:
        return [], done
    m = _CARD.match(text, at)
    digits = m.group().replace(" ", "").replace("-", "") if m.end() - at <= 40 else ""
    return [(at, m.end())] if 12 <= len(digits) <= 19 and luhn(digits) else [], m.end()


def _phone(text: str, at: int, end: int, done: int):
    m = _DIAL.match(text, end)
    if not m:
        return [], done
    last = m.end()
    while last > end and text[last - 1] not in _DIGITS:
        last -= 1
    if last < end + 2:
        return [], m.end()
    n = sum(c in _DIGITS for c in text[at:last]) if last - at <= 400 else sum(map(text.count, _DIGITS, [at] * 10, [last] * 10))
    return [(at, last)] if 9 <= n <= 15 else [], last


def _obscured(text: str, at: int, end: int, done: int):
    stop = at - (at > done and text[at - 1] == " ")
    first = _left(text, stop, done, _LOCAL)
    if first < stop and (m := _SPELT.match(text, end)):
        return [(first, m.end())], m.end()
    return [], done


def _login(text: str, at: int, end: int, done: int):
    first = _left(text, at, done, _SCHEME)
    m = _AUTHORITY.match(text, end)
    if first == at or not m:
        return [], done
    user, sign, host = m.group().rpartition("@")
    return ([(first, m.end())] if user.strip(":") and sign and host else []), m.end()


def _tel(text: str, at: int, end: int, done: int):
    m = _TEL.match(text, end)
    if not m or at < done or at and text[at - 1].isalnum():
        return [], done
    digits = sum(c in _DIGITS for c in m.group()) if m.end() - end <= 40 else 0
    last = m.end()
    while text[last - 1] not in _DIGITS:
        last -= 1
    return ([(at, last)] if 7 <= digits <= 15 else []), m.end()


def _cue(pattern: re.Pattern, accept: Callable[[re.Match], tuple[int, int] | None]):
    """A parser of what follows a word that stands by itself."""

    def parse(text: str, at: int, end: int, done: int):
        if at < done or at and (text[at - 1].isalnum() or text[at - 1] == "_"):
            return [], done
        m = pattern.match(text, end)
        span = accept(m) if m else None
        return ([span], span[1]) if span else ([], done)

    return parse


def _iban_ends(m: re.Match) -> tuple[int, int] | None:
    """The longest code with right check digits that starts there."""
    for last in range(m.end(1), m.start(1) + 14, -1):
        code = m.string[m.start(1) : last].replace(" ", "")
        if m.string[last - 1] != " " and len(code) >= 15 and not m.string[last : last + 1].isalnum() and mod97(code):
            return m.start(1), last
    return None


def _secret_ends(m: re.Match) -> tuple[int, int] | None:
    """A value with a digit and a letter: a sentence after the word is none."""
    span, value = m.span(m.lastindex), m[m.lastindex]
    return span if any(c in _DIGITS for c in value) and any(c.isalpha() for c in value) else None


_PARSERS = {
    "email": _email,
    "ip": _ip,
    "card": _card,
    "phone": _phone,
    "obscured": _obscured,
    "login": _login,
    "tel": _tel,
    "iban": _cue(_IBAN, _iban_ends),
    "account": _cue(_ACCOUNT, lambda m: m.span(1)),
    "ssn": _cue(_SSN, lambda m: (m.start(1), m.end(3)) if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000" else None),
    "secret": _cue(_SECRET, _secret_ends),
}


def automaton(kinds: Iterable[str] = KINDS) -> ahocorasick.Automaton:
    """The anchors of these kinds. An anchor's value is its length and the kinds whose parsers it calls."""
    anchors: dict[str, list[str]] = {}
    digits = sorted(_DIGITS)
    by_kind = {
        "email": ["@"],
        "ip": ["." + d for d in digits],
        "card": [a + gap + b for a in digits for gap in ("", " ", "-") for b in digits],
        "phone": ["+" + d for d in digits],
        "obscured": ["(at)", "[at]", "(AT)", "[AT]"],
        "login": ["://"],
        "tel": ["tel:", "sms:", "TEL:"],
    } | {kind: [f(w) for w in words for f in (str.lower, str.upper, str.capitalize)] for kind, words in CUES.items()}
    for kind in kinds:
        for anchor in by_kind[kind]:
            anchors.setdefault(anchor, []).append(kind)
    out = ahocorasick.Automaton()
    for anchor, wanted in anchors.items():
        out.add_word(anchor, (len(anchor), tuple(wanted)))
    out.make_automaton()
    return out


def spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, first, past the last) in code points, by first place and then in the order of KINDS."""
    done, found = dict.fromkeys(KINDS, 0), []
    for last, (size, kinds) in anchors.iter(text):
        for kind in kinds:
            got, done[kind] = _PARSERS[kind](text, last + 1 - size, last + 1, done[kind])
            found += [(kind, a, b) for a, b in got]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def find_spans(docs: DataFrame, kinds: Iterable[str] = KINDS, text: str = "text", out: str = "spans") -> DataFrame:
    """docs, with all their columns, and `out`: an array of (kind, start, end, value) of each text's personal data.

    Offsets are code points from 0, the end exclusive; spans stand by start, then in the order of KINDS. Spans of one kind
    never overlap, spans of different kinds may. email, ip, card and phone are exactly the leftmost matches of their patterns
    that validate (parts of an address at most 255, check digits of cards, 9 to 15 digits of a phone number). Added kinds:
    obscured (an address with "(at)"), login (a URL with user data), tel (a number behind tel: or sms:), iban (check digits
    right), account, ssn and secret (behind a word that announces them).

    Null and empty texts have no spans. Rows are judged one by one, so repeated rows, null ids and very long texts need
    nothing special; an empty table gives an empty one. A column named like `out` is an error, as one of the two would be
    lost; nothing is shuffled."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs has a column {out} already")
    ship(docs.sparkSession)
    place, wanted = docs.columns.index(text), [k for k in KINDS if k in set(kinds)]
    schema = StructType([*docs.schema, *StructType.fromDDL(f"`{out}` array<struct<kind:string,start:int,end:int,value:string>>")])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton(wanted)
        for batch in batches:
            rows = []
            for x in batch.column(place):
                t = x.as_py() or ""
                rows.append([{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in spans(t, anchors)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def redact(docs: DataFrame, kinds: Iterable[str] = KINDS, text: str = "text") -> DataFrame:
    """docs with each span of these kinds replaced by its kind in angle brackets; of spans that overlap, the first (of one
    start, the longest) stands for what it covers, and what reaches beyond it goes without a sign of its own. Null texts
    stay null."""
    (spans_col,) = unused(docs.columns, "spans")
    found = find_spans(docs, kinds, text, spans_col)
    by_place = F.array_sort(spans_col, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done, x):
        new = F.concat(done["parts"], F.array(F.substr(F.col(text), done["at"] + 1, x["start"] - done["at"]), F.concat(F.lit("<"), x["kind"], F.lit(">"))))
        parts = F.when(x["start"] >= done["at"], new).otherwise(done["parts"])
        return F.struct(F.greatest(x["end"], done["at"]).alias("at"), parts.alias("parts"))

    clean = F.aggregate(by_place, start, step, lambda done: F.concat(F.array_join(done["parts"], ""), F.substr(F.col(text), done["at"] + 1)))
    return found.select(*(F.when(F.size(spans_col) > 0, clean).otherwise(F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))


def listed(spans_col: str, kinds: Iterable[str] = KINDS):
    """kind:start:end of the spans of these kinds, comma-joined."""
    some = F.filter(spans_col, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: counts and digests of find_spans()."""
    found = find_spans(docs.select("doc_id", "text"), out="spans")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(listed("spans", BASE), 256).alias("base_sha256"), listed("spans").alias("spans"))
