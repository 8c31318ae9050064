"""Main text of web pages by equivalence-class template deduction (operator 1).

Every page is a sequence of tokens: element starts and ends told apart by their
path in the page (tags with their first class and id), and text runs told apart
by path and content. Tokens of one host that occur equally often on each of its
pages (equal occurrence vectors, compared through a commutative hash of page and
count) inside the same element form an equivalence class, if they are found on
enough pages.

Equal paths may play different roles, an advert's `div` and the article's, so
roles are told apart until nothing changes: a token that occurs the same number
of times on every page becomes as many roles, one for each place in the order;
and tokens that are in no class yet are told apart by the template element
around them and the gap between its inner template tokens in which they stand.
Each round forms classes anew from the finer roles (partition refinement; at
most `ROUNDS`).

Classes are kept if they are valid: on every page their tokens stand in the same
order, inside the same element of one parent class, and in the same gaps of that
parent class. So valid classes nest into a tree, the host's template; what lies
between its tokens fills slots.

The article is chosen among the template's elements by what varies: text of a
page that is no template token counts for all template elements around it.
Elements that hold most of the host's varying text, and most of its varying
headings, lie on one chain of the tree; the article is the one on that chain
that is marked up as an article, or else the deepest (on hosts with neither
markup nor headings the deepest that holds all varying text). Its slots, outside menus,
headers, footers, sidebars, notices, adverts, forms and comments, are the main
text; texts of the template are dropped there too. Hosts without a template,
and pages that lack the element, fall back on article markup, then on the whole
page outside such parts.

Edge cases: null or empty html gives an empty text; hosts with few different
pages have no template; equal pages count once when vectors are compared, and
each gets its row; a null url belongs to the host ''. Unclosed and stray tags,
attributes without quotes and stray quotes are read as browsers read them, in
one pass over pages of any length; elements nested deeper than `DEPTH` become
siblings. An empty table gives no row; other columns of the input are ignored.
A host may own any share of the rows: vectors are aggregated before they are
shuffled, and only templates (bounded by twice the mean number of tokens a
page) are sent or joined to pages. Templates too large for a broadcast are
joined by host; a large host's pages are then split by Spark's skew join.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import arrow_schema, discard, materialize, read, rows_to_batch, slices, texts
from docfacts.llm.url_filter import split_url

#: A class has to occur on this many different pages of a host, and on this share of them.
MIN_PAGES, MIN_SHARE = 3, 0.5
#: Share of a host's varying text, and of its varying headings, that the article's element holds.
MOST = 0.6
#: Templates of this many tokens in all are broadcast; more are joined.
BROADCAST_TOKENS = 500_000
#: Elements deeper than this become siblings, as in browsers.
DEPTH = 512
#: Rounds in which roles are told apart by their surroundings, and the most places in the order that one token is split into.
ROUNDS, PLACED = 2, 8
#: What the place in the order adds to a role, by exclusive or: the end of an element, its start's complement, stays the complement.
PLACE = [0, *(((k * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64)) - (1 << 63) for k in range(1, PLACED + 1))]

# One attribute, as browsers cut it: a name and a value in quotes or up to white space; quotes elsewhere are plain characters.
_VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)"""
_ATTRIBUTES = rf"(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+{_VALUE}?+)?+|=)*+"
TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # comment
    r"|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"  # doctype, instruction, end tag without a name
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(rf"""[\s/]*+(=?[^\s/>=]++)(?:\s*+=\s*+({_VALUE})?+)?+""")
WANTED = re.compile("class|id|role|aria-label", re.I)
DIGITS = re.compile("[0-9]{2,}")
NAME_PARTS = re.compile("[^a-z0-9]+")

# Element names of HTML by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math object".split())
SELF_CLOSING = {"svg", "math"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3"}
ASIDE_TAGS = set("nav header footer aside form menu dialog button select option fieldset head".split())
# Words of class, id, role and label that mark what is not main text, and words that may stand beside them.
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus"
    " footer form gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted related"
    " replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar tracking widget"
    " complementary contentinfo alert banners sidebars menus".split()
)
BESIDE_WORDS = set(
    "a an and area article articles bar block body bottom box buttons center col column container content floating for group head inner item items js left"
    " level line link links list main mobile module more of on our outer page panel post posts primary reader right row secondary section site slot small"
    " sticky story strip sub tertiary the thread top unit user ui view wide wrap wrapper".split()
)
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
HOLDS_P = {"article", "main", "div", "section", "td", "li", "blockquote", "body"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table", "select"}


def named(attributes: str) -> dict[str, str]:
    """Lower-cased class, id, role and aria-label of a tag; of repeated ones the first."""
    out: dict[str, str] = {}
    if "=" in attributes and WANTED.search(attributes):
        for m in ATTRIBUTE.finditer(attributes):
            name = m[1].lower()
            if name in ("class", "id", "role", "aria-label") and m[2]:
                out.setdefault(name, (m[2].strip("\"'") if m[2][0] in "\"'" else m[2]).lower())
    return out


def is_aside(tag: str, names: dict[str, str]) -> bool:
    """Whether an element is no main text: by its tag, or by a name all of whose words say so (`comment-list`, not `share-price`)."""
    if tag in ASIDE_TAGS:
        return True
    if tag in ("html", "body"):
        return False
    for value in names.values():
        for name in value.split():
            parts = {p for p in NAME_PARTS.split(name) if p and not p.isdigit()}
            if parts & ASIDE_WORDS and parts <= ASIDE_WORDS | BESIDE_WORDS:
                return True
    return False


def signature(tag: str, names: dict[str, str]) -> str:
    """The tag with its first class and its id, numbers of several digits folded, so that numbered elements are alike on all pages."""
    own = [DIGITS.sub("0", names[n].split()[0]) for n in ("class", "id") if names.get(n, "").strip()]
    return ".".join([tag, *own])


class Element:
    """An open element: its path as a hash, whether it lies in a part that is no main text or in marked main text, and whether it is what marks it."""

    __slots__ = ("tag", "path", "aside", "main", "marked")

    def __init__(self, tag: str, path: int, aside: bool, marked: bool, inside: bool = False):
        self.tag, self.path, self.aside, self.marked = tag, path, aside, marked and not aside
        self.main = self.marked or inside and not aside


OPEN, CLOSE, TEXT = 0, 1, 2


def events(page: str) -> Iterator[tuple[int, str, Element]]:
    """(kind, tag or text, element) of a page in order: elements open and close, texts stand in their element. Time is linear in the page."""
    digest = xxhash.xxh64_intdigest
    stack = [Element("", 0, False, False)]
    opened: dict[str, int] = {}
    at, end = 0, len(page)

    def pop_to(tags: set[str], stop: set[str] = frozenset()) -> list[Element]:
        """Closes elements up to the innermost of these tags, unless one of `stop` stands before it; an inline element leaves blocks in it open."""
        if any(opened.get(t) for t in tags):
            block = False
            for k in range(len(stack) - 1, 0, -1):
                block = block or stack[k].tag not in INLINE
                if stack[k].tag in tags:
                    last = k + 1 if block and stack[k].tag in INLINE else len(stack)
                    out = stack[k:last][::-1]
                    del stack[k:last]
                    for e in out:
                        opened[e.tag] -= 1
                    return out
                if stack[k].tag in stop:
                    break
        return []

    while at < end:
        start = page.find("<", at)
        m = TAG.match(page, start) if start >= 0 else None
        while start >= 0 and m is None:  # a plain character
            start = page.find("<", start + 1)
            m = TAG.match(page, start) if start >= 0 else None
        if start < 0:
            yield TEXT, page[at:], stack[-1]
            return
        if start > at:
            yield TEXT, page[at:start], stack[-1]
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                yield OPEN, "br", stack[-1]
            for own in pop_to({tag}):
                yield CLOSE, own.tag, own
            continue
        if tag in RAW and not (tag in SELF_CLOSING and m[3].endswith("/")):
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)|\Z", re.I).search(page, at)
            at = close.end()
            continue
        if tag in CLOSES_P:
            for own in pop_to({"p"}, HOLDS_P):
                yield CLOSE, own.tag, own
        if tag in SAME:
            for own in pop_to(SAME[tag], LISTS):
                yield CLOSE, own.tag, own
        if tag in VOID:
            yield OPEN, tag, stack[-1]
            continue
        if len(stack) > DEPTH:
            own = stack.pop()
            opened[own.tag] -= 1
            yield CLOSE, own.tag, own
        top, names = stack[-1], named(m[3])
        marked = tag in MAIN or names.get("role") == "main"
        own = Element(tag, digest(signature(tag, names), top.path), top.aside or is_aside(tag, names), marked, top.main)
        stack.append(own)
        opened[tag] = opened.get(tag, 0) + 1
        yield OPEN, tag, own


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def token_of(kind: int, value: str, element: Element) -> int:
    """An element's path, its complement for its end, and a hash of path and content for texts."""
    if kind == TEXT:
        return signed(xxhash.xxh64_intdigest(" ".join(value.split()), element.path))
    return signed(element.path) if kind == OPEN else ~signed(element.path)


#: Flags of a token: kind in the low bits, then in an aside, in a heading, opens marked main text, and for texts the length.
ASIDE, HEADING, MARKED, LENGTH = 4, 8, 16, 32


def token_list(found: list[tuple[int, str, Element]]) -> tuple[list[int], list[int], list[int]]:
    """The tokens of a page's events in order (elements and texts that are not blank), their flags, and the event of each."""
    tokens, flags, at, heading = [], [], [], 0
    for k, (kind, value, e) in enumerate(found):
        if kind == TEXT:
            n = len(value) - value.count(" ")
            if not n or value.isspace():
                continue
            flag = TEXT | n * LENGTH
        elif value in VOID:
            continue
        else:
            heading += (value in HEADINGS) * (1 if kind == OPEN else -1)
            flag = kind | MARKED * (kind == OPEN and e.marked)
        tokens.append(token_of(kind, value, e))
        flags.append(flag | ASIDE * e.aside | HEADING * (heading > 0))
        at.append(k)
    return tokens, flags, at


def page_tokens(page: str) -> tuple[list[int], list[int]]:
    return token_list(list(events(page)))[:2]


def in_order(roles: list[int], flags: list[int], split: set[int]) -> list[int]:
    """Roles of `split` told apart by their place in the page; an element's end follows its start."""
    if not split:
        return roles
    count: Counter[int] = Counter()
    opened: dict[int, list[int]] = {}
    out = []
    for t, f in zip(roles, flags, strict=True):
        kind = f & 3
        if kind == CLOSE:
            starts = opened.get(~t)
            out.append(~starts.pop() if starts else t)
            continue
        own = t
        if t in split:
            count[t] += 1
            own = t ^ PLACE[min(count[t], PLACED)]
        out.append(own)
        if kind == OPEN:
            opened.setdefault(t, []).append(own)
    return out


def in_gaps(roles: list[int], flags: list[int], template: set[int]) -> list[int]:
    """Roles outside the template told apart by the template element around them and the number of template tokens before them in it."""
    around = [[0, 0]]  # open template elements: role, template tokens passed directly inside
    opened: dict[int, list[int]] = {}
    out = []
    for t, f in zip(roles, flags, strict=True):
        kind, known = f & 3, t in template
        if kind == CLOSE:
            starts = opened.get(~t)
            own = ~starts.pop() if starts else t
            if around[-1][0] == ~own and len(around) > 1:
                around.pop()
        elif known:
            own = t
        else:
            own = signed(xxhash.xxh64_intdigest(b"%d %d" % (around[-1][0], around[-1][1]), t & 0xFFFFFFFFFFFFFFFF))
        out.append(own)
        around[-1][1] += known
        if kind == OPEN:
            opened.setdefault(t, []).append(own)
            if known:
                around.append([own, 0])
    return out


def shape(roles: list[int], flags: list[int]) -> tuple[list[int], list[int]]:
    """At each role's first occurrence how often it occurs (else 0), and the innermost element around it that occurs once."""
    counts, seen, around = Counter(roles), set(), [0]
    times, parents = [], []
    for t, f in zip(roles, flags, strict=True):
        kind = f & 3
        if kind == CLOSE and len(around) > 1 and around[-1] == ~t:
            around.pop()
        times.append(0 if t in seen else counts[t])
        parents.append(around[-1])
        seen.add(t)
        if kind == OPEN and counts[t] == 1:
            around.append(t)
    return times, parents


TOKENS = "host string, content long, tokens array<long>, flags array<long>, counts array<int>, parents array<long>"


def tokenised(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(TOKENS)
        for batch in batches:
            for part in slices(batch, "html", 2 << 20):
                rows = []
                for h, c, p in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    tokens, flags = page_tokens(p.as_py())
                    rows.append((h, c, tokens, flags, *shape(tokens, flags)))
                yield rows_to_batch(rows, schema)

    return texts(pages.filter(F.length("html") > 0), "host", F.xxhash64("html").alias("content"), "html").mapInArrow(run, TOKENS)


def roles(tokens: DataFrame) -> DataFrame:
    """(host, role, support, vector, parent, once, split): roles on enough pages of their host, inside one element. Tokens that occur equally often on all pages give a role for each place in the order."""
    sizes = tokens.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= MIN_PAGES)
    first = F.filter(F.arrays_zip("tokens", "counts", "parents"), lambda t: t["counts"] > 0)
    each = tokens.select("host", "content", F.explode(first).alias("t")).select("host", "content", "t.*")
    vectors = each.groupBy("host", "tokens").agg(
        F.count(F.lit(1)).alias("support"), F.bit_xor(F.xxhash64("content", "counts")).alias("vector"), F.bit_xor(F.xxhash64("content", F.lit(1))).alias("flat"),
        F.min("counts").alias("low"), F.max("counts").alias("high"), F.min("parents").alias("parent"), F.max("parents").alias("other"),
    ).filter((F.col("support") >= MIN_PAGES) & (F.col("parent") == F.col("other")))
    vectors = vectors.join(sizes, "host").filter(F.col("support") >= F.col("pages") * MIN_SHARE)
    split = (F.col("low") == F.col("high")) & F.col("low").between(2, PLACED)
    places = F.slice(F.array(*[F.lit(p) for p in PLACE[1:]]), 1, F.col("low"))
    own = F.when(split, F.transform(places, lambda p: F.col("tokens").bitwiseXOR(p))).otherwise(F.array("tokens"))
    return vectors.select(
        "host", F.explode(own).alias("role"), "support", F.when(split, F.col("flat")).otherwise(F.col("vector")).alias("vector"), "parent",
        (split | (F.col("high") == 1)).alias("once"), F.when(split, F.col("tokens")).alias("split"),
    )


def classes(found: DataFrame) -> DataFrame:
    """(host, class, support, once, tokens, splits): equivalence classes, with the tokens that were told apart by their order."""
    return found.groupBy("host", "support", "vector", "parent", "once").agg(F.collect_list("role").alias("tokens"), F.collect_set("split").alias("splits")).select(
        "host", F.xxhash64("support", "vector", "parent").alias("class"), "support", "once", "tokens", "splits"
    )


def by_host(found: DataFrame) -> DataFrame:
    """One row per host: its classes, most frequent and largest first."""
    each = F.struct("support", F.size("tokens").alias("n"), "class", "once", "tokens", "splits")
    return found.groupBy("host").agg(F.sort_array(F.collect_list(each), asc=False).alias("template"))


def attach(pages: DataFrame, templates: DataFrame, size: str) -> DataFrame:
    n = templates.agg(F.coalesce(F.sum(F.expr(size)), F.lit(0)).alias("n")).first()["n"]
    return pages.join(F.broadcast(templates) if n <= BROADCAST_TOKENS else templates, "host", "left")


TEMPLATE_SIZE = "aggregate(template, 0L, (s, c) -> s + size(c.tokens))"


def step_of(template: list[dict] | None) -> tuple[set[int], set[int]]:
    """(tokens told apart by their order, roles that occur once): what a round needs of a host's classes."""
    return {t for c in template or () for t in c["splits"]}, {t for c in template or () if c["once"] for t in c["tokens"]}


def refined(tokens: DataFrame, found: DataFrame) -> DataFrame:
    """The pages' tokens with roles told apart by order, then by surroundings, ready for the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known = arrow_schema(TOKENS), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                for host, content, own, flags, template in zip(*(batch.slice(at, 200).column(c) for c in ("host", "content", "tokens", "flags", "template")), strict=True):
                    key = host.as_py()
                    if key not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[key] = step_of(template.as_py())
                    split, once = known[key]
                    own, flags = own.as_py(), flags.as_py()
                    own = in_gaps(in_order(own, flags, split), flags, once)
                    rows.append((key, content.as_py(), own, flags, *shape(own, flags)))
                yield rows_to_batch(rows, schema)

    return attach(tokens.select("host", "content", "tokens", "flags"), by_host(found), TEMPLATE_SIZE).mapInArrow(run, TOKENS)


PLACES = "host string, class long, token long, ordered long, gap long, parent long, mass long, heading long, marked int, depth int"


def page_places(tokens: list[int], flags: list[int], owner: dict[int, int], ids: list[int]) -> Iterator[tuple]:
    """Of one page, (class, None, hashes of the order and of the gaps of its tokens, parent class) for each class, and (class, token,
    ..., varying text, varying headings, marked, depth) for each template element that occurs once; token 0 has the page's sums.

    The parent of a class is that of the innermost template element of another
    class around its first token; gaps count the parent's tokens before each
    token. owner: class number by token.
    """
    digest = xxhash.xxh64_intdigest
    seen = [0] * len(ids)
    parents: dict[int, int] = {}
    gaps: dict[int, dict[int, int]] = {}
    around: list[tuple[int, int]] = []  # open template elements: token, class number
    mass: dict[int, list[int]] = {}
    total, headings, once = 0, 0, Counter(t for t in tokens if t in owner)
    for t, f in zip(tokens, flags, strict=True):
        kind, k = f & 3, owner.get(t)
        if kind == CLOSE and around and around[-1][0] == ~t:
            around.pop()
        if k is not None:
            if k not in parents:
                parents[k] = next((c for _, c in reversed(around) if c != k), -1)
            parent = parents[k]
            gaps.setdefault(k, {}).setdefault(t, seen[parent] if parent >= 0 else 0)
            seen[k] += 1
            if kind == OPEN:
                around.append((t, k))
                if once[t] == 1:
                    mass.setdefault(t, [0, 0, int(f & MARKED > 0), len(around)])
        elif kind == TEXT and not f & ASIDE:
            n = f // LENGTH
            total += n
            headings += n * (f & HEADING > 0)
            for e, _ in around:
                if e in mass:
                    mass[e][0] += n
                    mass[e][1] += n * (f & HEADING > 0)
    for k, own in gaps.items():
        order, gap = (digest(repr(list(x))) >> 1 for x in (own, own.values()))
        yield ids[k], None, order, gap, ids[parents[k]] if parents[k] >= 0 else 0, 0, 0, 0, 0
    for e, (n, h, marked, depth) in mass.items():
        yield ids[owner[e]], e, 0, 0, 0, n, h, marked, depth
    yield 0, 0, 0, 0, 0, total, headings, 0, 0


def places(tokens: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows of page_places of all pages of hosts with classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PLACES)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                for row in batch.slice(at, 200).to_pylist():
                    if row["template"]:
                        owner = {t: k for k, c in enumerate(row["template"]) for t in c["tokens"]}
                        own = in_order(row["tokens"], row["flags"], step_of(row["template"])[0])
                        rows += [(row["host"], *r) for r in page_places(own, row["flags"], owner, [c["class"] for c in row["template"]])]
                yield rows_to_batch(rows, schema)

    joined = attach(tokens.select("host", "tokens", "flags"), templates, TEMPLATE_SIZE)
    return joined.mapInArrow(run, PLACES)


def deduce_templates(pages: DataFrame) -> DataFrame:
    """Of every host with a valid class: (host, splits, steps, tokens, article): what tells roles apart by order and by surroundings in each round, the
    roles of its template, and the one of the element that holds its articles (null: none does)."""
    raw = materialize(tokenised(pages), "page_tokens")
    tokens, rounds, had = raw.dropDuplicates(["host", "content"]), [], -1
    for k in range(ROUNDS + 1):
        found = materialize(classes(roles(tokens)), "classes")
        rounds.append(found)
        have = found.filter("once").agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("n")).first()["n"]
        if k == ROUNDS or have == had:
            break
        had, finer = have, materialize(refined(tokens, found), "page_roles")
        discard(raw)
        tokens = raw = finer
    placed = materialize(places(tokens, by_host(found)).groupBy("host", "class", "token").agg(
        *[f(c).alias(f"{c}_{f.__name__}") for c in ("ordered", "gap", "parent") for f in (F.min, F.max)],
        F.sum("mass").alias("mass"), F.sum("heading").alias("heading"), F.max("marked").alias("marked"), F.max("depth").alias("depth"),
    ), "places")
    same = " AND ".join(f"{c}_min = {c}_max" for c in ("ordered", "gap", "parent"))
    valid = placed.filter(f"token IS NULL AND {same}").select("host", "class")
    sums = placed.filter("token = 0").select("host", F.col("mass").alias("all"), F.col("heading").alias("all_headings"))
    elements = placed.filter("token <> 0").join(valid, ["host", "class"], "left_semi").join(sums, "host")
    # neither headings nor markup tell more of the host: then nothing that varies is left out
    least = F.when((F.col("marked") == 1) | (F.col("all_headings") > 0), F.lit(MOST)).otherwise(F.lit(1.0))
    chain = elements.filter((F.col("mass") > 0) & (F.col("mass") >= least * F.col("all")) & (F.col("heading") >= MOST * F.col("all_headings")))
    articles = chain.groupBy("host").agg(F.max_by("token", F.struct("marked", "depth")).alias("article"))
    template = found.join(valid, ["host", "class"]).groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    out = template.join(articles, "host", "left")
    for k, one in enumerate(rounds):
        steps = one.groupBy("host").agg(
            F.array_distinct(F.flatten(F.collect_list("splits"))).alias("split"), F.flatten(F.collect_list(F.when(F.col("once"), F.col("tokens")).otherwise(F.array().cast("array<long>")))).alias("once")
        )
        out = out.join(steps.select("host", F.struct("split", "once").alias(f"_{k}")), "host", "left")
    out = materialize(out.select("host", "tokens", "article", F.array(*[f"_{k}" for k in range(len(rounds))]).alias("steps")), "templates")
    discard(raw, placed, *rounds)
    return out


class Template:
    """A host's template: its roles, the role of the element that holds the articles, and what tells roles apart in each round."""

    def __init__(self, tokens=(), article: int | None = None, steps=()):
        self.roles, self.article = frozenset(tokens), article
        self.steps = [(set(s["split"] or ()), set(s["once"] or ())) for s in steps if s is not None]

    def roles_of(self, tokens: list[int], flags: list[int]) -> list[int]:
        for k, (split, once) in enumerate(self.steps):
            tokens = in_order(tokens, flags, split)
            if k < len(self.steps) - 1:
                tokens = in_gaps(tokens, flags, once)
        return tokens


NOTHING = Template()


def main_text(page: str | None, template: Template = NOTHING) -> str:
    """Text of the article's slots, block by block in page order."""
    if not page:
        return ""
    blocks: list[tuple[str, bool, bool]] = []  # text, in the template's article, in marked main text
    run: list[str] = []
    state = [False, False, True]  # in the article, marked, constant
    inside = 0

    def close():
        text = " ".join("".join(run).split())
        if text and not state[2]:
            blocks.append((text, state[0], state[1]))
        run.clear()
        state[2] = True

    found = list(events(page))
    roles_at: dict[int, int] = {}
    if template.roles:
        tokens, flags, at = token_list(found)
        roles_at = dict(zip(at, template.roles_of(tokens, flags), strict=True))
    for k, (kind, value, e) in enumerate(found):
        if kind == TEXT:
            if not e.aside:
                state[0], state[1] = inside > 0, e.main
                state[2] = state[2] and (not value.strip() or roles_at.get(k) in template.roles)
                run.append(html_entities.unescape(value))
            continue
        if value not in INLINE:
            close()
        if template.article is not None and k in roles_at and roles_at[k] == (template.article if kind == OPEN else ~template.article):
            inside += 1 if kind == OPEN else -1
    close()
    for k in (1, 2):
        if any(b[k] for b in blocks):
            return " ".join(b[0] for b in blocks if b[k])
    return " ".join(b[0] for b in blocks)


EXTRACTED = "page_id long, url string, text string, n_chars long, template_tokens int"


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, template_tokens) of every page."""
    host, _ = split_url(F.col("url"))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    templates = deduce_templates(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known = arrow_schema(EXTRACTED), {}
        for batch in batches:
            rows = []
            for page_id, url, page, host, tokens, article, steps in zip(*(batch.column(c) for c in ("page_id", "url", "html", "host", "tokens", "article", "steps")), strict=True):
                key = host.as_py()
                if key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = Template(tokens.as_py() or (), article.as_py(), steps.as_py() or ())
                text = main_text(page.as_py(), known[key])
                rows.append((page_id.as_py(), url.as_py(), text, len(text), len(known[key].roles)))
            yield rows_to_batch(rows, schema)

    return attach(pages, templates, "size(tokens) + aggregate(steps, 0, (s, x) -> s + coalesce(size(x.once), 0))").mapInArrow(run, EXTRACTED)


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
