"""Secret scans: patterns, and a lexer that knows assignments.

Base spans are the leftmost non-overlapping matches of three patterns: `assign` (a telling
name, a value of 12 characters or more), `access` (access keys) and `hex` (16 or more).

The lexer adds `literal` spans.  It visits every `=`, `:`, `:=` and `=>` of a text, reads the
name before it (identifiers with dots and dashes, quoted keys, subscripts: Python,
JavaScript, JSON, YAML, INI, shell) and the value behind it: a quoted literal (also with a
prefix like `b` or `f`, in triple quotes, on the next line or in round brackets), several joined
by `+` or, in brackets, by nothing, a bare word of configuration, another name, names joined with
literals, the default of a lookup (`getenv("NAME", "value")`, `x or "value"`, `x || "value"`,
`x ?? "value"`; the looked up name is a target too), or a YAML block of lines without a space.
`a, b = x, y` gives each name its value; `#define NAME "value"` is an assignment.  `name: Type = value` is one assignment,
to the name (a telling word of the type counts too), and a type alone gives nothing.
Literals given to names are constants; a name given to a sensitive name passes its literal on,
through any number of steps: the one it was last given before that place of the text, or, if
it has none there, the first one after it.
A literal is reported if the weight of its most sensitive target name times the literal's own
strength (length, mixed characters, variety; placeholders and plain words count nothing)
reaches `least`.  The span is the literal without quotes.

Null and empty texts have no spans; an empty table gives one.  Long texts are read whole, each
place a bounded number of times.  Spans are in code points, end exclusive, ordered by
start and kind.  Repeated rows give equal results; extra columns stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The base patterns.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "literal")

# How telling a word of a target name is, alone or next to "key".
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6, "authorization": 0.7, "privatekey": 1.0, "accesskey": 1.0,
    "signature": 0.5, "salt": 0.5, "pin": 0.3,
}
KEY_COMPANY = {"api", "access", "private", "secret", "signing", "encryption", "auth", "client", "service", "account", "storage", "master", "ssh", "license"}
PLACEHOLDERS = re.compile(r"(?i)change.?me|example|placeholder|your[-_ ]|xxx|dummy|redacted|\*\*\*|\.\.\.|^<.*>$|^\$\{?|^%\(|^\{\{|environ|getenv|^(true|false|null|none|undefined)$")

_OPERATOR = re.compile(r":=|=>|(?<![=!<>:+*/-])=(?![=~])|:(?![:/=])")
_QUOTE = r"""(?:[bBrRuUfFL]{1,2}(?=["']))?(?=["'`])"""
_VALUE = re.compile(
    r"""[ \t]*(?:[bBrRuUfFL]{1,2}(?=["']))?(?:\"{3}((?:[^\\]|\\.)*?)\"{3}|'{3}((?:[^\\]|\\.)*?)'{3}"""
    r"""|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`]*)`|([^\s"'`,;()\[\]{}]+))""",
    re.S,
)
_BARE = 6
_AHEAD = re.compile(rf"""[ \t]*(?:\\?\r?\n[ \t]*(?={_QUOTE})|(?P<open>\()\s*(?={_QUOTE}))""")
_JOIN = re.compile(rf"""\s*\+\s*(?={_QUOTE})|[ \t]*\+[ \t]*(?=[A-Za-z_$])""")
_NEXT = re.compile(rf"\s*(?={_QUOTE})")
_NAMED = re.compile(rf"[ \t]*([A-Za-z_$][\w$.]*+)(?=[ \t]+\+[ \t]|[ \t]*\+[ \t]*{_QUOTE})", re.ASCII)
_LOOKUP = re.compile(
    rf"""[ \t]*(?:(?P<call>[A-Za-z_$][\w$.]*)\([ \t]*(?P<q>["'])(?P<key>[^"'\n]*)(?P=q)[ \t]*(?:,[ \t]*(?:default[ \t]*=[ \t]*)?(?={_QUOTE})|\)[ \t]*(?:\|\||\?\?|\bor\b)[ \t]*(?={_QUOTE}))"""
    rf"""|(?P<name>[A-Za-z_$][\w$.]*)(?:\[[ \t]*["'](?P<item>[^"'\n]*)["'][ \t]*\])?[ \t]*(?:\|\||\?\?|\bor\b)[ \t]*(?={_QUOTE}))""",
    re.ASCII,
)
_BLOCK = re.compile(r"[ \t]*[|>][-+]?\d?[ \t]*\r?\n(?=[ \t]+\S)")
_BLOCK_LINE = re.compile(r"[ \t]+([^\s|>]+)[ \t]*(?:\r?\n|\Z)")
_TARGETS = re.compile(r"^[ \t]*\(?([A-Za-z_$][\w$.]*(?:[ \t]*+,[ \t]*+[A-Za-z_$][\w$.]*)++)[ \t]*\)?[ \t]*(?==[^=~>])", re.M | re.ASCII)
_COMMA = re.compile(r"[ \t]*,")
_LINE_END = re.compile(r"[ \t]*\)?[ \t]*(?:;|#|//|\r?\n|\Z)")
_DEFINE = re.compile(r"^[ \t]*#[ \t]*define[ \t]+([A-Za-z_]\w*)(?=[ \t]+[L]?[\"'])", re.M | re.ASCII)
_TYPE_WORD = re.compile(r"""[ \t]*(?:(?:[&*?]|mut\b|dyn\b|'\w+(?=[ \t]))[ \t]*)*(?:[A-Za-z_$][\w$.]*|"[^"\n]*"|'[^'\n]*')""")
_TYPE_PART = re.compile(r"[ \t]*([\[(<])|[?!]")
_TYPE_MORE = re.compile(r"[ \t]*[|&]")
_GIVEN = re.compile(r"[ \t]*=(?![=~>])")
_BRACKETS = re.compile(r"[\[\]()<>]")
#: Parts that a joined name passes on (`k = k + k` doubles them each time); the others are reported where they stand, by their own names.
JOINED = 64
_IDENTIFIER = re.compile(r"[A-Za-z_$][\w$.]*\Z", re.ASCII)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_weight(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    words = [w.lower() for w in _WORDS.findall(name)]
    best = max((WEIGHTS.get(w, 0.0) for w in words), default=0.0)
    if any(w in ("key", "keys") and i and words[i - 1] in KEY_COMPANY for i, w in enumerate(words)):
        best = 1.0
    return best


def strength(literal: str) -> float:
    """How much a literal looks like key material, 0 to 1."""
    n = len(literal)
    if n < 8 or PLACEHOLDERS.search(literal) or " " in literal.strip() or literal.isalpha() and (literal.islower() or literal.istitle()):
        return 0.0
    bits = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    classes = sum(any(map(test, literal)) for test in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in literal)
    return min(1.0, bits / 3.0) * min(1.0, 0.4 + 0.2 * classes) * min(1.0, 0.5 + n / 24)


def _name_before(text: str, end: int) -> str:
    """The name that ends before a sign, or an empty one."""
    while end and text[end - 1] in " \t":
        end -= 1
    stop = end
    while stop and text[stop - 1] in "\"']":
        stop -= 1
    start = stop
    while start and (text[start - 1].isalnum() or text[start - 1] in "_$.-") and text[start - 1].isascii():
        start -= 1
    return text[start:stop]


def _pairs(text: str) -> dict[int, int]:
    """Where each bracket that opens is closed; each kind is paired by itself."""
    opened: dict[str, list[int]] = {"]": [], ")": [], ">": []}
    out = {}
    for mark in _BRACKETS.finditer(text):
        if mark[0] in opened:
            if opened[mark[0]]:
                out[opened[mark[0]].pop()] = mark.start()
        else:
            opened[{"[": "]", "(": ")", "<": ">"}[mark[0]]].append(mark.start())
    return out


def _past_type(text: str, at: int, pairs: dict[int, int]) -> tuple[int, int] | None:
    """Start and end of the `=` behind a type, if that is what stands here; `pairs` is filled when a bracket asks for it."""
    while word := _TYPE_WORD.match(text, at):
        at = word.end()
        while part := _TYPE_PART.match(text, at):
            at = part.end()
            if part[1]:
                if not pairs:
                    pairs.update({-1: -1} | _pairs(text))
                close = pairs.get(part.start(1))
                if close is None:
                    return None
                at = close + 1
        if given := _GIVEN.match(text, at):
            return given.end() - 1, given.end()
        more = _TYPE_MORE.match(text, at)
        if not more:
            return None
        at = more.end()
    return None


#: The parts of a literal: spans, and names whose literals stand between them.
Parts = list[tuple[int, int] | str]


def _stripped(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a].isspace():
        a += 1
    while a < b and text[b - 1].isspace():
        b -= 1
    return a, b


def _value_at(text: str, at: int) -> tuple[Parts, str | None, int]:
    """Parts of a literal, the name that stands there instead of one, and where it ends."""
    parts: Parts = []
    source = None
    ahead = _AHEAD.match(text, at)
    brackets = bool(ahead and ahead["open"])
    at = ahead.end() if ahead else at
    while True:
        if named := _NAMED.match(text, at):
            part, at, quoted = named[1], named.end(), False
            parts.append(part)
        else:
            value = _VALUE.match(text, at)
            if not value:
                break
            kind, at = value.lastindex, value.end()
            quoted = kind != _BARE
            if kind == _BARE and _IDENTIFIER.match(value[kind]):
                if parts:
                    parts.append(value[kind])
                else:
                    source = value[kind]
                    parts.append(value.span(kind))
            elif kind != _BARE or not parts:
                parts.append(_stripped(text, *value.span(kind)) if kind in (1, 2) else value.span(kind))
        more = (_JOIN.match(text, at) if quoted or isinstance(parts[-1], str) else None) or (_NEXT.match(text, at) if brackets and quoted else None)
        if not more:
            break
        at = more.end()
    if all(isinstance(p, str) for p in parts):
        return [], None, at
    return parts, source, at


def _block_at(text: str, at: int) -> Parts:
    """Lines without a space under a YAML block sign."""
    parts: Parts = []
    head = _BLOCK.match(text, at)
    at = head.end() if head else len(text)
    while line := _BLOCK_LINE.match(text, at):
        parts.append(line.span(1))
        at = line.end()
    return parts


def _looked_up(text: str, at: int) -> tuple[list[str], int]:
    """Names that are looked up in front of a default, and where the default stands."""
    found = _LOOKUP.match(text, at)
    if not found:
        return [], at
    return [n for n in (found["key"], found["item"], found["name"]) if n], found.end()


def _unpacked(text: str, names: list[str], at: int) -> list[tuple[str, Parts, str | None]]:
    """`a, b = x, y` as one assignment for each name, if there are as many values."""
    out = []
    for i, name in enumerate(names):
        parts, source, at = _value_at(text, at)
        if not parts:
            return []
        out.append((name, parts, source))
        comma = _COMMA.match(text, at) if i + 1 < len(names) else _LINE_END.match(text, at)
        if not comma:
            return []
        at = comma.end()
    return out


def lex(text: str) -> list[tuple[str, Parts, str | None]]:
    """Assignments in order: target name, parts of its literal, or the name it is given."""
    out, colons, types, done = [], [], set(), set()
    pairs: dict[int, int] = {}
    unpacked = {m.end(): [n.strip() for n in m[1].split(",")] for m in _TARGETS.finditer(text)} if "," in text else {}
    defined = [(m.start(1), m) for m in _DEFINE.finditer(text)] if "define" in text else []
    signs = sorted([(m.start(), m) for m in _OPERATOR.finditer(text)] + defined, key=lambda s: s[0]) if defined else [(m.start(), m) for m in _OPERATOR.finditer(text)]
    for start, sign in signs:
        if start in done:
            continue
        if sign.lastindex:
            parts, source, _ = _value_at(text, sign.end())
            if parts:
                out.append((sign[1], parts, source))
            continue
        name = _name_before(text, start)
        if start in unpacked and (found := _unpacked(text, unpacked[start], sign.end())):
            out += found
            continue
        if not name:
            continue
        typed = _past_type(text, sign.end(), pairs) if sign[0] == ":" else None
        if typed:
            names, at = _looked_up(text, typed[1])
            parts, source, _ = _value_at(text, at)
            first = parts[0] if parts else None
            if parts and (text[typed[0] - 1] in " \t" or isinstance(first, tuple) and text[first[0] - 1] in "\"'`"):
                done.add(typed[0])
                word = _name_before(text, typed[0])
                types.add(word)
                out += [(n, parts, source) for n in (*names, word, name) if n]
                continue
            if source is not None:  # `name: a=b` can be a type and a name, or one bare word
                out.append((name, parts, source))
        if sign[0] == ":" and (parts := _block_at(text, sign.end())):
            out.append((name, parts, None))
            continue
        names, at = _looked_up(text, sign.end())
        parts, source, _ = _value_at(text, at)
        if sign[0] == ":" and source is not None:
            colons.append(len(out))
        out += [(n, parts, source) for n in (*names, name) if parts]
    bare = {i for i in colons if out[i][2] in types}  # types without a value
    return [a for i, a in enumerate(out) if i not in bare]


def _resolved(found: list[tuple[str, Parts, str | None]]) -> list[list[tuple[int, int]] | None]:
    """The literal that each assignment gives its name, if it can be told."""
    values: list[list[tuple[int, int]] | None] = [None] * len(found)
    bound: dict[str, list[int]] = {}
    waiting: dict[str, list[int]] = {}
    for i, (name, parts, source) in enumerate(found):
        if source is None:  # a name among the parts stands for what it was last given; an unknown one for nothing
            values[i] = [q for p in parts for q in ([p] if isinstance(p, tuple) else values[bound[p][-1]][:JOINED] if p in bound else [])]
        elif source in bound:
            values[i] = values[bound[source][-1]]
        if values[i] is None:
            waiting.setdefault(source, []).append(i)
        else:
            bound.setdefault(name, []).append(i)
    ready = [source for source in waiting if source in bound]
    while ready:
        source = ready.pop()
        for i in waiting.pop(source, ()):
            at = bisect_left(bound[source], i)
            values[i] = values[bound[source][max(at - 1, 0)]]
            insort(bound.setdefault(found[i][0], []), i)
            ready.append(found[i][0])
    return values


def literal_spans(text: str, least: float = 0.5) -> list[tuple[int, int]]:
    """Spans of literals that sensitive names hold, directly or through constants."""
    reach: dict[tuple[tuple[int, int], ...], float] = {}
    assigned = lex(text)
    for (name, parts, _), value in zip(assigned, _resolved(assigned), strict=True):
        weight = name_weight(name)
        own = tuple(p for p in parts if isinstance(p, tuple))
        for key in {own, tuple(value or own)} if weight else ():  # a name can be a bare word
            reach[key] = max(weight, reach.get(key, 0.0))
    found = []
    for spans, weight in reach.items():
        if weight * strength("".join(text[a:b] for a, b in spans)) >= least:
            found += spans
    return sorted(set(found))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    """Counts by base kind, digest of the base spans, and all spans."""
    base = base_spans(text or "")
    kinds = Counter(k for k, _, _ in base)
    spans = sorted(base + [("literal", a, b) for a, b in literal_spans(text or "")], key=lambda s: (s[1], KINDS.index(s[0])))
    return kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)


_NAMES = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]


@F.arrow_udf(returnType=T.StructType([T.StructField(n, T.LongType() if n.startswith("n_") else T.StringType()) for n in _NAMES]))
def _scan(texts: pa.Array) -> pa.Array:
    rows = [scan_text(t) for t in texts.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], _NAMES)


_scan = _scan.asNondeterministic()


def scan(docs: DataFrame) -> DataFrame:
    """The documents with counts, digest and spans of their secrets; clashing own columns give way."""
    own = [c for c in docs.columns if c not in (*_NAMES, "_scan")]
    return docs.select(*own, _scan(F.col("text")).alias("_scan")).select(*own, "_scan.*")
