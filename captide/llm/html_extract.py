"""Main text of web pages by templates that are deduced per host from equivalence classes of tokens.

A page is read as a stream of blocks. Its tokens are the tag paths in it (with class and id) and its blocks (path and
text). Over the pages of a host, a token has an occurrence vector: how often it stands on each page. Tokens with equal
vectors form an equivalence class. Vectors are compared by their support and by an order-free hash of ``(page, count)``
pairs, which is a plain aggregate: a host with a third of all pages is counted map-side like any other. A class is valid
if it has ``CLASS_TOKENS`` tokens or more, stands on most pages of a host of ``HOST_PAGES`` or more, and is

- ordered: on every page its tokens come in one order, over and over. Tokens that leave the order of the class's first page
  (by its hash) on any page, as they lie outside a longest rising run, are no part of it;
- nested: on every page what lies between its first and last token holds other classes whole, or lies whole in one slot of them.
  Of two classes that cross, the one on fewer pages is not valid, or the one of fewer tokens.

A token outside the valid classes has a role of its own in each slot: before, it was counted with its like elsewhere on the page.
Classes of these roles are searched in the next round, until no frequent vector changes. The classes of the last round are the
template. What they leave open are slots.

A block is taken if it is no token of the template and stands in an open slot of the main part: inside ``article`` or ``main``
if the page has one, anywhere else if not, and in no element that is a menu, header, footer, sidebar, notice, advert,
form, script, style or reader comment by its tag, role, class or id.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import staged

HOST_PAGES = 4
SUPPORT = 0.6
CLASS_TOKENS = 2
SALTS = 16
MAX_ROUNDS = 40
# What repeats from page to page is worked out once by a worker, if it has so many characters at most.
SHORT = 512

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|title|textarea|xmp)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
OUTSIDE = frozenset(
    "nav footer aside form script style noscript template svg math iframe object canvas audio video button select option textarea"
    " input label fieldset dialog menu head".split()
)
# Elements that end where the next of their kind begins.
ENDS = {
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
MAIN = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words in a class or id that name what is no part of an article.
NAMES = frozenset(
    "ad ads adbox adblock adslot adunit advert adverts advertisement advertising sponsor sponsored promo promos promotion banner nav navbar"
    " navigation menu menubar breadcrumb breadcrumbs header masthead footer foot sidebar aside widget widgets cookie cookies consent gdpr"
    " notice notices notification alert popup modal overlay comment comments commentlist disqus reply replies respond share sharing social"
    " related recommended newsletter subscribe subscription signup login search form pagination pager toolbar skip".split()
)
# Inside the main part an element named header holds the headline.
HEADS = frozenset(["header", "masthead", "banner"])


def _is_outside(tag: str, named: list[tuple[str, str]], in_main: bool) -> bool:
    if tag in OUTSIDE or tag == "header" and not in_main:
        return True
    for name, value in named:
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id") and tag not in ("body", "html"):
            words = {w.lower() for w in _PARTS.split(value)} | {value.lower()}
            if words & (NAMES - HEADS if in_main else NAMES):
                return True
    return False


@functools.lru_cache(maxsize=1 << 14)
def _element(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """The label of an element in paths, whether its role is the main part, and whether it is outside, not in the main part and in it."""
    named = [(m[1], m[2] or m[3] or m[4] or "") for m in _NAMED.finditer(attributes)]
    label = tag + "".join(f"#{n.lower()}={v}" for n, v in named if n.lower() in ("class", "id"))
    role = any(n.lower() == "role" and v.lower() == "main" for n, v in named)
    return label, role, _is_outside(tag, named, False), _is_outside(tag, named, True)


def read_page(source: str) -> list[tuple[str, str | None, bool, bool]]:
    """The tags and blocks of a page in its order, as ``(path, text, in main part, outside)``; a tag has no text."""
    parts = []
    # Of each open element: tag, path, in the main part, outside of what is wanted.
    stack = [("", "", False, False)]
    pieces: list[str] = []

    def end_block():
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            _, path, in_main, outside = stack[-1]
            parts.append((path, text, in_main, outside))

    def pop_to(depth):
        end_block()
        del stack[depth:]

    at = 0
    for match in _TOKEN.finditer(source):
        if match.start() > at:
            pieces.append(html.unescape(source[at : match.start()]))
        at = match.end()
        tag = match["tag"] or match["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if match["close"] or match["close2"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            # A stray end tag of an inner element does not end what stands around it.
            crosses = any(e[0] in BLOCKS for e in stack[depth + 1 :]) and tag not in BLOCKS
            if depth and not crosses:
                if tag in BLOCKS or stack[-1][3] != stack[depth - 1][3]:
                    pop_to(depth)
                else:
                    del stack[depth:]
            elif tag in BLOCKS:
                end_block()
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCKS:
            end_block()
        closed = ENDS.get(tag, ("p",) if tag in BLOCKS else ())
        while closed and any(e[0] == "p" for e in stack) and tag in BLOCKS and "p" in closed:
            depth = max(i for i, e in enumerate(stack) if e[0] == "p")
            if any(e[0] in BLOCKS for e in stack[depth + 1 :]):
                break
            pop_to(depth)
        while stack[-1][0] in closed:
            pop_to(len(stack) - 1)
        attributes = match["attributes"] or match["attributes2"] or ""
        label, role, own, own_in_main = _element(tag, attributes) if len(attributes) <= SHORT else _element.__wrapped__(tag, attributes)
        _, path, in_main, outside = stack[-1]
        path = f"{path}/{label}"
        parts.append((path, None, in_main, outside))
        if tag in VOID or (match["attributes"] or "").endswith("/") and tag not in BLOCKS:
            continue
        starts = tag in MAIN or role
        own = own_in_main if in_main else own
        if starts and not in_main and not own:
            # What stands around the main part, and may have been left open, does not reach into it.
            in_main, outside = True, False
        else:
            outside = outside or own
        if outside != stack[-1][3]:
            end_block()
        stack.append((tag, path, in_main, outside))
    pieces.append(html.unescape(source[at:]))
    end_block()
    return parts


def token(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@functools.lru_cache(maxsize=1 << 16)
def _token(*parts: str) -> int:
    return token(*parts)


def page_tokens(parts: list[tuple]) -> list[int]:
    tokens = []
    for path, text, *_ in parts:
        named = (path,) if text is None else (path, text)
        tokens.append((_token if sum(map(len, named)) <= SHORT else token)(*named))
    return tokens


def out_of_order(tokens: list[int], classes: dict[int, tuple]) -> set[int]:
    """Tokens of ``classes`` (``token: (class, rank, size, support)``) that leave the order of ranks on a page."""
    seen, turns = Counter(), {}
    for t in tokens:
        if t in classes:
            turns.setdefault(classes[t][0], []).append((seen[t], classes[t][1], t))
            seen[t] += 1
    gone = set()
    for run in turns.values():
        # A longest rising run: the least ends of runs of each length, and the one before each item.
        ends, at, before = [], [], []
        for i, item in enumerate(run):
            k = bisect_left(ends, item)
            ends[k : k + 1] = [item]
            before.append(at[k - 1] if k else -1)
            at[k : k + 1] = [i]
        i, kept = at[-1], set()
        while i >= 0:
            kept.add(i)
            i = before[i]
        gone |= {t for i, (*_, t) in enumerate(run) if i not in kept}
    return gone


def walk(tokens: list[int], classes: dict[int, tuple]):
    """Yields each token with the slot it stands in, ``(class, rank)`` or none, and the open classes it crosses."""
    stack: list[list] = []
    for t in tokens:
        if t not in classes:
            yield t, tuple(stack[-1]) if stack else None, []
            continue
        name, rank, size, _ = classes[t]
        crossed = []
        if any(name == open_name for open_name, _ in stack):
            while stack[-1][0] != name:
                crossed.append(stack.pop()[0])
            stack[-1][1] = rank
        else:
            stack.append([name, rank])
        yield t, None, [(name, other) for other in crossed]
        if rank == size - 1:
            stack.pop()


def roles(tokens: list[int], classes: dict[int, tuple]) -> list[int]:
    """The tokens of a page, those outside the classes told apart by their slots."""
    return [_token(str(t), *map(str, slot)) if slot else t for t, slot, _ in walk(tokens, classes)]


def main_text(source: str, template: list[dict[int, tuple]]) -> str:
    """The blocks of the main part that the template, the classes of each round, leaves open, one per line."""
    parts = read_page(source)
    tokens = page_tokens(parts) if template else [0] * len(parts)
    *rounds, last = template or [{}]
    for classes in rounds:
        tokens = roles(tokens, classes)
    wanted = [(part, t in last) for part, t in zip(parts, tokens) if part[1] is not None and not part[3]]
    if any(part[2] for part, _ in wanted):
        wanted = [(part, fixed) for part, fixed in wanted if part[2]]
    open_slots = [part[1] for part, fixed in wanted if not fixed]
    # Where the pages of a host are copies of each other, nothing tells the template from the text.
    return "\n".join(open_slots or [part[1] for part, _ in wanted])


def host_of(url) -> F.Column:
    """The lower-case host of a URL; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


CLASSES = "array<struct<token: bigint, class: bigint, rank: int, size: int, support: bigint>>"


def _as_dict(classes) -> dict[int, tuple]:
    return {c["token"]: (c["class"], c["rank"], c["size"], c["support"]) for c in classes or ()}


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields])


def _salted(found: DataFrame) -> DataFrame:
    # Spark broadcasts the classes if they are small; if not, a hot host is dealt out by salts.
    return found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _page_salt():
    return F.pmod("page", F.lit(SALTS)).cast("int")


def frequent_vectors(sequences: DataFrame) -> DataFrame:
    """``host, token, support, vector, first``: the frequent tokens of ``host, page, tokens``; ``first`` is a page and a place in it."""
    fields = [("host", pa.string()), ("page", pa.int64()), ("token", pa.int64()), ("n", pa.int64()), ("at", pa.int64())]

    def scan(batches):
        for batch in batches:
            rows = []
            for host, page, tokens in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "tokens"))):
                counts = Counter(tokens)
                places = {t: i for i, t in reversed(list(enumerate(tokens)))}
                counts[0] = 1
                rows += [(host, page, t, n, places.get(t, -1)) for t, n in counts.items()]
            yield _batch(rows, fields)

    counts = sequences.select("host", "page", "tokens").mapInArrow(scan, "host string, page bigint, token bigint, n bigint, at bigint")
    vectors = counts.groupBy("host", "token").agg(
        F.count("*").alias("support"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.min(F.struct("page", "at")).alias("first")
    )
    vectors = staged(vectors.where("support > 1"), "occurrence-vectors")
    hosts = vectors.where("token = 0").select("host", F.col("support").alias("pages")).where(f"pages >= {HOST_PAGES}")
    return vectors.join(hosts, "host").where(f"support >= {SUPPORT} * pages")


def _classes(members: DataFrame) -> DataFrame:
    """``host, classes``: the classes of ``CLASS_TOKENS`` tokens or more among ``host, token, support, class, place``, ranked by place."""
    grouped = members.groupBy("host", "class", "support").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("tokens"))
    grouped = grouped.where(F.size("tokens") >= CLASS_TOKENS)
    ranked = grouped.select("host", "class", "support", F.size("tokens").alias("size"), F.posexplode("tokens").alias("rank", "t"))
    return ranked.groupBy("host").agg(F.collect_list(F.struct("t.token", "class", "rank", "size", "support")).cast(CLASSES).alias("classes"))


def _with_classes(sequences: DataFrame, found: DataFrame, how: str) -> DataFrame:
    joined = sequences.withColumn("salt", _page_salt()).join(_salted(found), ["host", "salt"], how)
    return joined.select("host", "page", "tokens", "classes")


def valid_classes(sequences: DataFrame, frequent: DataFrame) -> DataFrame:
    """``host, classes``: the equivalence classes of frequent tokens that are ordered and nested on all pages."""
    kinds = "host string, item bigint"
    fields = [("host", pa.string()), ("item", pa.int64())]

    def faults(find):
        def scan(batches):
            for batch in batches:
                out = set()
                for host, tokens, classes in zip(*(batch.column(c).to_pylist() for c in ("host", "tokens", "classes"))):
                    out |= {(host, item) for item in find(tokens, _as_dict(classes))}
                yield _batch(sorted(out), fields)

        return scan

    def crossing(tokens, classes):
        strength = {name: (support, size, name) for name, _, size, support in classes.values()}
        return {min(pair, key=strength.get) for _, _, crossed in walk(tokens, classes) for pair in crossed}

    name = F.xxhash64("support", "vector").alias("class")
    members = staged(frequent.where("token <> 0").select("host", "token", "support", name, F.col("first.at").alias("place")), "members")
    disordered = _with_classes(sequences, _classes(members), "inner").mapInArrow(faults(out_of_order), kinds).distinct()
    members = members.join(disordered.withColumnRenamed("item", "token"), ["host", "token"], "left_anti")
    ordered = staged(members, "ordered-members")
    crossed = _with_classes(sequences, _classes(ordered), "inner").mapInArrow(faults(crossing), kinds).distinct()
    return _classes(ordered.join(crossed.withColumnRenamed("item", "class"), ["host", "class"], "left_anti"))


def templates(pages: DataFrame) -> DataFrame:
    """``host, template``: the valid classes of each round, of every host that has any, from ``host, page, html``."""
    fields = [("host", pa.string()), ("page", pa.int64()), ("tokens", pa.list_(pa.int64()))]
    kinds = "host string, page bigint, tokens array<bigint>"

    def scan(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("host", "page", "html"))
            yield _batch([(host, page, page_tokens(read_page(source or ""))) for host, page, source in zip(*columns)], fields)

    def told_apart(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("host", "page", "tokens", "classes"))
            yield _batch([(host, page, roles(tokens, _as_dict(classes))) for host, page, tokens, classes in zip(*columns)], fields)

    sequences = staged(pages.mapInArrow(scan, kinds), "tokens")
    found, before = None, None
    for number in range(MAX_ROUNDS):
        frequent = frequent_vectors(sequences)
        state = frequent.agg(F.count("*"), F.sum(F.xxhash64("host", "support", "vector").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        classes = staged(valid_classes(sequences, frequent), "classes")
        named = classes.select("host", F.struct(F.lit(number).alias("round"), "classes").alias("found"))
        found = named if found is None else found.union(named)
        sequences = staged(_with_classes(sequences, classes, "left").mapInArrow(told_apart, kinds), "roles")
    else:
        raise RuntimeError(f"the classes still change after {MAX_ROUNDS} rounds")
    return found.groupBy("host").agg(F.sort_array(F.collect_list("found")).alias("template"))


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text``: one row per row of ``pages``.

    Blocks stand in page order, one per line, with character references decoded and white space as single spaces. A null or empty page has an
    empty text; pages without a URL count as one host; malformed and very long pages are read whole; repeated rows give
    repeated rows; an empty table gives none. Other columns are not carried.
    """
    source = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html")
    )
    named = source.withColumns({"host": host_of(F.col("url")), "page": F.xxhash64("page_id", "url")})
    found = staged(templates(named.select("host", "page", "html")), "templates")
    joined = named.withColumn("salt", _page_salt()).join(_salted(found), ["host", "salt"], "left")

    def rounds(template):
        classes = {r["round"]: _as_dict(r["classes"]) for r in template or ()}
        return [classes.get(number, {}) for number in range(max(classes, default=-1) + 1)]

    def extract(batches):
        for batch in batches:
            texts = [main_text(h or "", rounds(t)) for h, t in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = source.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "template").mapInArrow(extract, f"page_id {kind}, url string, text string")
