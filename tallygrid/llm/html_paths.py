"""HTML extraction by consensus host paths.

1. Every page is read into text runs, each under its path of containers.  A step of a path is
   the tag and its classes with digits generalised, so pages of one template share paths.
   Elements that say what they are (nav, aside, footer, scripts, hidden parts, ...) are left out
   while reading.  Forms, and parts whose class or id is as a whole the name of a sidebar, notice,
   advert, comment list and the like (alone or with neutral words: `site-footer`, `comment-list`;
   not `has-sidebar`, `ad-hoc`), are in doubt: a page leaves such a part out unless it holds most of
   the page's text that isn't in links, with next to nothing outside of parts in doubt (and no
   text of an article or main part, if it isn't inside one itself).
   Where pages of a host differ on a part, the host keeps it if half of its pages or more do.
2. A page scores each of its paths: the share of its text under the path, less text in links,
   more for deeper paths and telling names.
3. A page votes for its best path with that score, or for the article or main part around it.
   Spark adds the votes up per host and path, after partial aggregation, and takes the first
   path of each host.
4. Outside of articles and main parts, the path is widened to the highest container that adds
   text (not in links) which is mostly not boilerplate.  Boilerplate is a block that two
   different pages of those that voted for the path have; a page alone shows none.
5. Every page is read again and gives the text under its host's path; a page without that
   path gives that of its own best.

Null html gives the empty string, as does a page without text.  A null url votes under the
empty host.  Repeated rows count as pages of their own; ties go to the path that comes first.
White space inside a block becomes one space; blocks are joined by one.  Extra columns stay;
own columns `text` and `n_chars` give way.  Long pages are read whole; an empty table gives one.
The rulings that a host sends to its pages are at most `RULINGS`, those on parts of most pages
first; a page reads other parts in doubt its own way.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import small_by_bytes

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
# Elements by role in HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split())
UNSEEN = {"wbr", "img"}  # inside words and lines: no border of a block
DROPPED = set("head nav footer aside button select option template svg math object canvas audio video map menu dialog".split()) | RAW
CONTAINERS = set("body div section article main center table tbody tr td th ul ol dl fieldset details figure".split())
LEAVES = set("p li dt dd option h1 h2 h3 h4 h5 h6 blockquote pre address summary caption figcaption header hgroup".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
DROPPED_NAMES = set(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar "
    "footer masthead cookie cookies consent gdpr notice alert notification popup modal overlay newsletter subscribe subscription signup login comments comment "
    "disqus replies reply respond share sharing social related recommended recommendations pagination pager toolbar widget search skip hidden".split()
)
NEUTRAL = set(
    "site page main global blog post posts entry article articles left right top bottom primary secondary inner outer area box bar list item items section wrap wrapper container "
    "content body block group panel row column col inline links link button buttons icon icons form title text unit slot id js ui the my".split()
)
HEADERS = set("header site page main global top wrapper container inner".split())
TELLING = set("article main content post entry story text body".split())
#: Tags that tell of an article inside a part in doubt.
SHOWN = {"h1", "main", "article", "p"}
#: Code points of text that a part in doubt needs to be read without such a tag.
PROSE = 200
#: Steps of a path; what is nested deeper belongs to the last one.
STEPS = 128
#: Rulings that a host sends to its pages.
RULINGS = 256
_NAME = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): references.unescape(a or b or c) for name, a, b, c in _ATTR.findall(text)} if "=" in text or text.strip() else {}


def _dropped(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element says itself that it isn't part of an article."""
    if tag in DROPPED or tag == "header" and not inside or "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in DROPPED_ROLES:
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def _doubtful(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether a form, or a part whose class or id is as a whole the name of something else than an article."""
    if tag in ("article", "main"):
        return False
    if tag == "form":
        return True
    for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        parts = set(_NAME.findall(token))
        if parts & DROPPED_NAMES and parts <= DROPPED_NAMES | NEUTRAL or "header" in parts and parts <= HEADERS and not inside:
            return True
    return False


def _step(tag: str, attrs: dict[str, str]) -> str:
    classes = sorted({_DIGITS.sub("0", c.lower()) for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes]).replace("/", "|")


@dataclass
class Part:
    """A part in doubt: the one around it, its name on the host, whether it is inside an article, and what lies in it.

    `own` and `told` (some of it in an article) are of the text outside of inner parts, `size` and `tags` of all.
    """

    parent: int
    name: str
    form: bool
    inside: bool
    own: int = 0
    told: bool = False
    size: int = 0
    tags: set[str] = field(default_factory=set)


@dataclass
class Reading:
    """A page's text runs (path, text, in a link, innermost part in doubt or -1) and its parts in doubt, outer ones first."""

    runs: list[tuple[str, str, bool, int]] = field(default_factory=list)
    parts: list[Part] = field(default_factory=list)
    told: bool = False

    def kept(self, rulings: dict[str, bool] | None = None) -> list[bool]:
        """For each part in doubt, whether the page reads it: as ruled, or else as the page itself shows."""
        total = free = 0
        for _, text, link, part in self.runs:
            size = 0 if link else len(text.strip())
            total += size
            if part < 0:
                free += size
        before, out = [], []
        for part in self.parts:
            around, told = before[part.parent] if part.parent >= 0 else (free, self.told)
            before.append((around + part.own, told or part.told))
            prose = part.size >= PROSE or part.tags & {"h1", "main", "article"} or part.form and "p" in part.tags
            most = 2 * part.size > total and bool(prose) and (10 * around < total and (part.inside or not told) or bool(part.tags & {"h1", "main"}))
            out.append((most if rulings is None else rulings.get(part.name, most)) and (part.parent < 0 or out[part.parent]))
        return out

    def visible(self, rulings: dict[str, bool] | None = None) -> list[tuple[str, str, bool]]:
        kept = self.kept(rulings)
        return [(path, text, link) for path, text, link, part in self.runs if part < 0 or kept[part]]


def read(page: str) -> Reading:
    """The text runs of a page in page order; a block's border is a space."""
    out = Reading()
    # Open elements: tag, path, left out, in a link, inside an article, innermost part in doubt.
    stack: list[tuple[str, str, bool, bool, bool, int]] = [("", "", False, False, False, -1)]
    at, end = 0, len(page)

    def say(text: str, link: bool) -> None:
        _, path, left, _, inside, part = stack[-1]
        if not left:
            out.runs.append((path, text, link, part))
            if part >= 0 and not link:
                out.parts[part].own += len(text.strip())
            if inside and not link and text.strip():
                if part >= 0:
                    out.parts[part].told = True
                else:
                    out.told = True

    while at < end:
        mark = page.find("<", at)
        found = _MARKUP.match(page, mark) if mark >= 0 else None
        if mark < 0 or found is None:
            stop = end if mark < 0 else mark + 1
            say(references.unescape(page[at:stop]), stack[-1][3])
            at = stop
            continue
        if mark > at:
            say(references.unescape(page[at:mark]), stack[-1][3])
        at = found.end()
        if found["cdata"] is not None:
            say(found["cdata"], stack[-1][3])
        if not found["tag"]:
            continue
        tag, closing = found["tag"].lower(), bool(found["close"])
        if tag not in INLINE and tag not in UNSEEN:
            out.runs.append((stack[-1][1], " ", False, -1))
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth and not (tag in INLINE and any(s[0] not in INLINE for s in stack[depth + 1 :])):
                del stack[depth:]
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            while len(stack) > 1 and (stack[-1][0] in INLINE or stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or tag in ("li", "dt", "dd", "option", "tr", "td", "th") and stack[-1][0] == tag):
                stack.pop()  # a block ends inline elements and paragraphs that were left open
        _, path, left, link, inside, part = stack[-1]
        attrs = _attributes(found["attrs"]) if not left else {}
        whole = tag in ("html", "body")
        left = left or not whole and _dropped(tag, attrs, inside)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if not found["attrs"].rstrip().endswith("/") or tag in INLINE | CONTAINERS:
            if not left and not whole and _doubtful(tag, attrs, inside):
                name = f"{path}/{_step(tag, attrs)}#{_DIGITS.sub('0', attrs.get('id', '').lower())}"
                out.parts.append(Part(part, hashlib.md5(name.encode("utf-8", "replace")).hexdigest()[:16], tag == "form", inside))
                part = len(out.parts) - 1
            if part >= 0 and tag in SHOWN and not left:
                out.parts[part].tags.add(tag)
            if tag in CONTAINERS and not left and path.count("/") < STEPS:
                path = f"{path}/{_step(tag, attrs)}"
            stack.append((tag, path, left, link or tag == "a", inside or tag in ("article", "main"), part))
    for part in out.parts:
        part.size = part.own
    for part in reversed(out.parts):
        if part.parent >= 0:
            out.parts[part.parent].size += part.size
            out.parts[part.parent].tags |= part.tags
    return out


def runs(page: str) -> list[tuple[str, str, bool]]:
    """(path, text, in a link) of what a page by itself shows."""
    return read(page).visible()


def scores(page: str | None) -> dict[str, float]:
    """Each path of a page with its score, 0 to about 2."""
    return _scores(runs(page or ""))


def _scores(pieces: list[tuple[str, str, bool]]) -> dict[str, float]:
    own: dict[str, float] = {}
    total = 0
    for path, text, link in pieces:
        size = not text.isspace() and len(text)
        if not size:
            continue
        own[path] = own.get(path, 0.0) + (-size if link else size)
        total += size
    if not total:
        return {}
    under: dict[str, float] = {}
    for path, size in own.items():
        steps = path.split("/")
        for i in range(1, len(steps)):
            part = "/".join(steps[: i + 1])
            under[part] = under.get(part, 0.0) + size
    out = {}
    for path, size in under.items():
        last = path.rsplit("/", 1)[1]
        telling = bool(set(_NAME.findall(last)) & TELLING) and not last.startswith("body")
        out[path] = size / total * (1 + 0.1 * path.count("/")) * (1.2 if telling else 1.0)
    return {p: s for p, s in out.items() if s > 0}


def enclosing(path: str) -> str | None:
    """The outermost article of a path, or else its outermost main part."""
    steps = path.split("/")
    for tag in ("article", "main"):
        for i, step in enumerate(steps):
            if step.partition(".")[0] == tag:
                return "/".join(steps[: i + 1])
    return None


def best(found: dict[str, float]) -> str | None:
    if not found:
        return None
    first = min(found, key=lambda p: (-found[p], p))
    return enclosing(first) or first


def further(pieces: list[tuple[str, str, bool]], path: str) -> list[tuple[str, bytes, int]]:
    """(container, digest, size) of the blocks around a path; the container is the innermost one of the path that holds them."""
    steps = path.split("/")
    tops = ["/".join(steps[:i]) for i in range(len(steps) - 1, 0, -1)]
    blocks: list[tuple[str, str]] = []
    for where, text, link in pieces:
        if link or _within(where, path):
            continue
        if text == " " or not blocks or blocks[-1][0] != where:
            blocks.append((where, ""))
        blocks[-1] = (where, blocks[-1][1] + text)
    found = {(next(top for top in tops if _within(where, top)), " ".join(text.split())) for where, text in blocks if text.strip()}
    return [(top, hashlib.md5(text.encode("utf-8", "replace")).digest(), len(text)) for top, text in sorted(found)]


def text_under(page: str | None, path: str | None, rulings: dict[str, bool] | None = None) -> str:
    """The text under a path, or under the page's own best path if it doesn't have that one."""
    if not page:
        return ""
    pieces = read(page).visible(rulings)
    if path is None or not any(_within(p, path) and not t.isspace() for p, t, _ in pieces):
        path = best(_scores(pieces)) or ""
    return " ".join("".join(t if _within(p, path) else " " for p, t, _ in pieces).split())


def _within(path: str, top: str) -> bool:
    return path == top or path.startswith(f"{top}/") or not top


_VOTES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("vote", T.DoubleType()),
    T.StructField("further", T.ArrayType(T.StructType([T.StructField("top", T.StringType()), T.StructField("block", T.BinaryType()), T.StructField("size", T.LongType())]))),
    T.StructField("doubts", T.ArrayType(T.StructType([T.StructField("part", T.StringType()), T.StructField("kept", T.BooleanType())]))),
])
_ARROW = pa.struct([
    ("path", pa.string()), ("vote", pa.float64()), ("further", pa.list_(pa.struct([("top", pa.string()), ("block", pa.binary()), ("size", pa.int64())]))),
    ("doubts", pa.list_(pa.struct([("part", pa.string()), ("kept", pa.bool_())]))),
])


@F.arrow_udf(returnType=_VOTES)
def _votes(pages: pa.Array) -> pa.Array:
    out = []
    for page in pages.to_pylist():
        reading = read(page or "")
        pieces = reading.visible()
        found = _scores(pieces)
        path = best(found)
        around = [dict(zip(("top", "block", "size"), x, strict=True)) for x in further(pieces, path)] if path and not enclosing(path) else []
        doubts: dict[str, bool] = {}
        for part, kept in zip(reading.parts, reading.kept(), strict=True):
            doubts[part.name] = doubts.get(part.name, False) or kept
        out.append({"path": path, "vote": max(found.values(), default=None), "further": around, "doubts": [{"part": k, "kept": v} for k, v in doubts.items()]})
    return pa.array(out, _ARROW)


@F.arrow_udf(returnType=T.StringType())
def _text(pages: pa.Array, paths: pa.Array, keep: pa.Array, leave: pa.Array) -> pa.Array:
    rows = zip(pages.to_pylist(), paths.to_pylist(), keep.to_pylist(), leave.to_pylist(), strict=True)
    return pa.array([text_under(p, w, dict.fromkeys(k or (), True) | dict.fromkeys(x or (), False)) for p, w, k, x in rows], pa.string())


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, keep, leave): the winning path of each host, widened, and its rulings on parts that its pages differ on."""
    voted = pages.select(host(F.col("url")).alias("host"), F.md5("html").alias("page"), _votes.asNondeterministic()(F.col("html")).alias("v"))
    voted = materialize(voted.select("host", "page", "v.*"), "host-ballots")
    ballots = voted.where("path is not null")
    counted = ballots.groupBy("host", "path").agg(F.round(F.sum("vote"), 6).alias("votes"))
    first = counted.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("lost"), "path")).alias("w"))
    winners = first.select("host", F.col("w.path").alias("path"), (-F.col("w.lost")).alias("votes"))
    around = ballots.where(F.size("further") > 0).join(winners.select("host", "path"), ["host", "path"])
    blocks = around.select("host", "page", F.explode("further").alias("f")).select("host", "page", "f.*").distinct()
    blocks = blocks.groupBy("host", "top", "block").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    own = F.sum(F.when(F.col("n") == 1, F.col("size")).otherwise(0))
    tops = blocks.groupBy("host", "top").agg(own.alias("own"), F.sum("size").alias("size")).where("2 * own > size")
    highest = tops.groupBy("host").agg(F.min_by("top", F.length("top")).alias("top"))
    doubts = voted.where(F.size("doubts") > 0).select("host", F.explode("doubts").alias("d")).groupBy("host", "d.part")
    doubts = doubts.agg(F.count_if("d.kept").alias("kept"), F.count("*").alias("n")).where("kept > 0 and kept < n")
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "part"))
    ruled = doubts.withColumn("place", place).where(F.col("place") <= RULINGS).groupBy("host").agg(
        F.collect_list(F.when(F.expr("2 * kept >= n"), F.col("part"))).alias("keep"), F.collect_list(F.when(F.expr("2 * kept < n"), F.col("part"))).alias("leave"),
    )
    found = winners.join(highest, "host", "left").join(ruled, "host", "full")
    return found.select("host", F.coalesce("top", "path").alias("path"), "votes", "keep", "leave")


def extract(pages: DataFrame) -> DataFrame:
    """The pages with `text` and `n_chars`, without their html."""
    winners = materialize(host_paths(pages), "host-paths")
    own = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    row = pages.select(F.struct(*own).alias("_own"), "html", host(F.col("url")).alias("host"))
    ways = winners.select("host", F.col("path").alias("_path"), F.col("keep").alias("_keep"), F.col("leave").alias("_leave"))
    joined = row.join(small_by_bytes(ways), "host", "left")
    text = joined.select("_own", _text.asNondeterministic()(F.col("html"), F.col("_path"), F.col("_keep"), F.col("_leave")).alias("text"))
    return text.select("_own.*", "text", F.length("text").cast("long").alias("n_chars"))
