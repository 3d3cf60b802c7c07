"""Main text of web pages by deduction of the templates of their hosts.

A page is a sequence of tokens: tags, told apart by where in the document they stand, and whole texts
between tags. Over the pages of a host each token has an occurrence vector, the number of its
occurrences on every page; tokens with equal vectors form an equivalence class. Classes of enough
tokens on enough pages are the host's template. On a page a class is valid if its tokens come in the
template's order, and if it lies inside one slot of the largest class, in which it is then nested.
Tokens of valid classes are template; what remains are the texts of the slots. Texts of a class are
template only where they recur beside many differing texts: those of a copied page recur beside none
of its own, so they stay, however often the page is copied. Kept are the slots of
the article, without those in menus, headers, footers, sidebars, notices, adverts, forms and comments.

Vectors are not stored: a class is recognised by two sums over pages of hash times count, which add up
before the shuffle, for a host of any size. Hosts with too few pages use the template of all pages.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from sluicebox.llm.common import spread, written

MIN_PAGES = 5
MIN_SHARE = 0.1
MIN_TOKENS = 3
FIXED_TEXT_PAGES = 20
OWN_SHARE = 0.2
SALTS = 32

# Fixed values of HTML: elements without an end, with raw text, and that end a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody tfoot thead tr ul".split()
)
# elements that a new one of the same group ends
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("article aside blockquote body div dl fieldset footer form header html li main nav ol section table td th ul".split())
CELLS = frozenset(["br", "td", "th"])
# Elements and names of classes that never hold an article's text.
DROPPED = frozenset("nav footer aside form button select label head menu dialog object canvas audio video".split()) | RAW
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar sidebars footer comment comments disqus reply replies share sharing social related "
    "recommended widget widgets toolbar pagination pager skip masthead topbar".split()
)
ROLES = frozenset("navigation banner complementary contentinfo search form alert alertdialog dialog menu menubar".split())
MAIN_NAMES = frozenset("article content post entry story main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[^a-z0-9]+")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found.group(1).lower() if found else ""


class Node:
    """A token of a page: a tag, or the text between two tags. Its path, the elements around it, is kept
    as a running hash, so that deep pages cost no more than flat ones."""

    __slots__ = ("kind", "name", "path", "text", "dropped", "main", "token")

    def __init__(self, kind: str, name: str, path: int, text: str, dropped: bool, main: int):
        self.kind, self.name, self.path, self.text, self.dropped, self.main = kind, name, path, text, dropped, main
        key = f"{path}\0{kind}\0{text if kind == 'text' else name}".encode()
        self.token = xxh64_intdigest(key) >> 1


def _labels(attributes: str) -> tuple[str, set[str], str]:
    """What of a tag's attributes tells it apart, the words of its class and id, its role."""
    if "=" not in attributes:
        return "", set(), ""
    shown, words, role = [], set(), ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() == "role":
            role = value
        else:
            words.update(_PARTS.split(value))
        shown.append(f"{name.lower()}={_DIGITS.sub('9', value)}")
    return " ".join(sorted(shown)), words - {""}, role


def parse(html: str) -> list[Node]:
    """Tokens of a page in order. `main` tells how sure it is that a token stands in the article: 3 in
    an article element, 2 in a main one, 1 in one named like it, 0 elsewhere. An element is dropped for
    its name unless it holds the page's article."""
    nodes: list[Node] = []
    # of each open element: name, path, whether its text is dropped, `main`, and the innermost element
    # around that is dropped for its name, and the innermost article or main element around, or -1
    stack: list[tuple[str, int, bool, int, int, int]] = [("", 0, False, 0, -1, -1)]
    # of each element dropped for its name: the next such element around it
    names: list[int] = []
    # of each article or main element: its path, the innermost element around that is dropped for its
    # name, and the next article or main element around
    articles: list[tuple[int, int, int]] = []
    # of each node: the innermost element around that is dropped for its name, and the innermost article
    around: list[tuple[int, int]] = []
    at = 0

    def add(kind: str, name: str, path: int, text: str, dropped: bool, main: int, named: int, inside: int) -> None:
        nodes.append(Node(kind, name, path, text, dropped, main))
        around.append((named, inside))

    def text(until: int) -> None:
        if until > at and (data := html[at:until]):
            add("text", "", stack[-1][1], entities.unescape(data), *stack[-1][2:])

    while found := _TAG.search(html, at):
        text(found.start())
        at = found.end()
        name = (found.group(1) or found.group(3) or "").lower()
        end = (found.group(5) or "").lower()
        if name:
            attributes = found.group(2) or found.group(4) or ""
            if name in BLOCKS and name not in CLOSES and name != "html":
                _end(stack, {"p"})
            if name in CLOSES:
                _end(stack, CLOSES[name] | {"p"})
            label, words, role = _labels(attributes)
            _, path, dropped, main, named, inside = stack[-1]
            shown = f"{name}[{label}]" if label else name
            in_article = main == 3
            dropped = (
                dropped or name in DROPPED or role in ROLES
                or name == "header" and not in_article or "hidden" in attributes.lower().split()
            )
            is_main = name in ("article", "main") or role == "main"
            if words & NAMES and not is_main and name not in ("html", "body"):
                names.append(named)
                named = len(names) - 1
            inner = xxh64_intdigest(f"{path}/{shown}".encode())
            if is_main and not dropped:
                articles.append((inner, named, inside))
                inside = len(articles) - 1
            if not dropped:
                own = 3 if name == "article" else 2 if name == "main" or role == "main" else 1 if words & MAIN_NAMES and name not in ("html", "body") else 0
                main = max(main, own)
            add("open", shown, path, "", dropped, main, named, inside)
            if name in RAW:
                close = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(html, at)
                at = close.end() if close else len(html)
                add("close", shown, path, "", True, main, named, inside)
            elif name not in VOID and not attributes.endswith("/"):
                stack.append((name, inner, dropped, main, named, inside))
        elif end:
            if end in VOID:
                add("open", end, stack[-1][1], "", *stack[-1][2:])
                continue
            depth = len(stack) - 1
            while depth and stack[depth][0] != end:
                # an inline element does not end the blocks around it
                if stack[depth][0] in SCOPES and end not in BLOCKS and end not in ("td", "th"):
                    depth = 0
                    break
                depth -= 1
            if depth:
                del stack[depth:]
            add("close", end, stack[-1][1], "", *stack[-1][2:])
    text(len(html))
    if names:
        _drop_named(nodes, around, articles, names)
    return nodes


def _drop_named(nodes: list[Node], around: list[tuple[int, int]], articles: list[tuple[int, int, int]], names: list[int]) -> None:
    """Drop what stands in an element dropped for its name, unless that element holds the page's
    article: the article or main elements of a path with the most text. If it has less text than stands
    outside and nothing there is marked, neither is known to be the article, and both are kept."""
    held: set[int] = set()
    if any(named >= 0 for _, named, _ in articles):
        # text of each article that no dropped element inside it holds, its inner articles' included
        own, marked, plain = [0] * len(articles), 0, 0
        for node, (named, inside) in zip(nodes, around):
            if node.kind != "text" or node.dropped or not (n := len(node.text.strip())):
                continue
            if inside >= 0 and articles[inside][1] == named:
                own[inside] += n
            if named < 0:
                marked, plain = marked + n * (node.main > 0), plain + n * (node.main == 0)
        sizes: Counter = Counter()
        for k in range(len(articles) - 1, -1, -1):
            path, named, outer = articles[k]
            sizes[path] += own[k]
            if outer >= 0 and articles[outer][1] == named:
                own[outer] += own[k]
        # of equals the first
        best = max((path for path, named, _ in articles if named >= 0), key=sizes.__getitem__)
        if sizes[best] > marked:
            for path, named, _ in articles:
                while path == best and named >= 0 and named not in held:
                    held.add(named)
                    named = names[named]
            if not marked and plain > sizes[best]:
                for node in nodes:
                    node.main = 0
    kept: list[bool] = []
    for k, outer in enumerate(names):
        kept.append(k in held and (outer < 0 or kept[outer]))
    for node, (named, _) in zip(nodes, around):
        node.dropped = node.dropped or named >= 0 and not kept[named]


def _end(stack: list[tuple], names: set[str]) -> None:
    """Close the innermost open element of these names, unless a container lies in between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth][0] in names:
            del stack[depth:]
            return
        if stack[depth][0] in SCOPES:
            return


def _occurrences(batches):
    """A row for each distinct token of a page; token 0 stands for the page."""
    for batch in batches:
        rows = []
        for page, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
            host = host_of(url)
            key = f"{page}\0{url}".encode()
            # two hashes of 31 bits: their sums stay far below the range of a bigint
            hashed = xxh64_intdigest(key)
            one, two = hashed >> 33, hashed & 0x7FFFFFFF
            nodes = [n for n in parse(html or "") if n.kind != "text" or n.text.strip()]
            counts, first, levels = Counter(), {}, {}
            for place, node in enumerate(nodes):
                counts[node.token] += 1
                first.setdefault(node.token, place)
                if node.kind == "text":
                    levels[node.token] = max(_level(node), levels.get(node.token, -1))
            rows.append((host, 0, False, -1, 1, one, two, 0))
            rows.extend((host, t, t in levels, levels.get(t, -1), n, n * one, n * two, first[t]) for t, n in counts.items())
        yield pd.DataFrame(rows, columns=["host", "token", "is_text", "level", "n", "one", "two", "place"])


def _level(node: Node) -> int:
    """`main` of a text that can be kept, -1 of any other token."""
    return node.main if node.kind == "text" and not node.dropped else -1


def _classes(counted: DataFrame, min_pages: int, min_share: float, min_tokens: int, fixed_text_pages: int) -> DataFrame:
    """`host, class, tokens`: the tokens of a host's equivalence classes, as (place, token, level),
    from its tokens with `of_host`, the number of its pages."""
    vector = F.xxhash64("pages", "n", "one", "two").alias("class")
    found = counted.where("token <> 0").where(
        (F.col("pages") >= F.greatest(F.lit(min_pages), F.col("of_host") * min_share))
        & (~F.col("is_text") | (F.col("pages") >= fixed_text_pages))
    )
    members = found.select("host", vector, "token", "level", (F.col("place") / F.col("pages")).alias("place"))
    return (
        members.groupBy("host", "class").agg(F.array_sort(F.collect_list(F.struct("place", "token", "level"))).alias("tokens"))
        .where(F.size("tokens") >= min_tokens)
    )


def _of_hosts(classes: DataFrame) -> DataFrame:
    """`host, template`: all classes of a host in a row."""
    fields = F.struct("class", F.col("tokens.token").alias("tokens"), F.col("tokens.level").alias("levels"))
    return classes.groupBy("host").agg(F.collect_list(fields).alias("template"))


def _texts(batches):
    """The texts of each page that can be kept: tokens, numbers of characters, levels."""
    for batch in batches:
        rows = []
        for url, html in zip(batch["url"], batch["html"]):
            found = [n for n in parse(html or "") if _level(n) >= 0 and n.text.strip()]
            rows.append((host_of(url), [n.token for n in found], [len(n.text.strip()) for n in found], [n.main for n in found]))
        yield pd.DataFrame(rows, columns=["host", "tokens", "chars", "levels"])


def beside(texts: list[tuple[int, int, int]], template) -> list[tuple[int, int, int, int, int]]:
    """For each class and level that has texts on a page: a hash of the page's own texts of that level
    or above, which are in no class, their characters, and those of the class. `texts` are the page's
    tokens, characters and levels."""
    classes = [(e["class"], {int(t) for t, level in zip(e["tokens"], e["levels"]) if level >= 0}) for e in template]
    fixed = set().union(*(tokens for _, tokens in classes))
    out = []
    for level in {level for token, _, level in texts if token in fixed}:
        above = [(t, n) for t, n, at in texts if at >= level]
        own = [t for t, _ in above if t not in fixed]
        hashed = xxh64_intdigest(",".join(map(str, own)).encode()) >> 1
        own_chars = sum(n for t, n in above if t not in fixed)
        here = {t for t, _, at in texts if at == level}
        out.extend(
            (name, level, hashed, own_chars, sum(n for t, n in above if t in tokens))
            for name, tokens in classes if own and not tokens.isdisjoint(here)
        )
    return out


def _beside(shared):
    def compare(batches):
        common = shared.value
        for batch in batches:
            rows = []
            for host, tokens, chars, levels, template in zip(*(batch[c] for c in ("host", "tokens", "chars", "levels", "template"))):
                texts = list(zip(map(int, tokens), map(int, chars), map(int, levels)))
                rows.extend((None, *found) for found in beside(texts, common))
                if template is not None:
                    rows.extend((host, *found) for found in beside(texts, template))
            yield pd.DataFrame(rows, columns=["host", "class", "level", "own", "own_chars", "class_chars"])

    return compare


def _recurring(compared: DataFrame, fixed_text_pages: int, own_share: float) -> DataFrame:
    """`host, class, fixed_levels`: where texts of a class stand beside enough differing texts. Pages of
    equal texts of their own count once."""
    once = compared.groupBy("host", "class", "level", "own").agg(F.max("own_chars").alias("own_chars"), F.max("class_chars").alias("class_chars"))
    sums = once.groupBy("host", "class", "level").agg(
        F.count(F.lit(1)).alias("contents"), F.sum("own_chars").alias("own_chars"), F.sum("class_chars").alias("class_chars")
    )
    enough = (F.col("contents") >= fixed_text_pages) & (F.col("own_chars") >= F.col("class_chars") * own_share)
    return sums.where(enough).groupBy("host", "class").agg(F.collect_set("level").alias("fixed_levels"))


def _with_recurring(classes: DataFrame, recurring: DataFrame, on: list[str]) -> DataFrame:
    """Classes without the texts that are not template."""
    held = lambda t: (t["level"] < 0) | F.array_contains("fixed_levels", t["level"])
    joined = classes.join(recurring, on, "left").withColumn("fixed_levels", F.coalesce("fixed_levels", F.array().cast("array<int>")))
    return joined.withColumn("tokens", F.filter("tokens", held)).where(F.size("tokens") > 0).drop("fixed_levels")


def template_tokens(nodes: list[Node], template) -> set[int]:
    """Tokens of the classes that are valid on this page."""
    places = defaultdict(list)
    for place, node in enumerate(nodes):
        places[node.token].append(place)
    valid: list[list[int]] = []
    for entry in template if template is not None else ():
        tokens = [int(t) for t in entry["tokens"]]
        counts = {len(places[t]) if t in places else 0 for t in tokens}
        firsts = [places[t][0] for t in tokens if t in places]
        if len(counts) == 1 and 0 not in counts and firsts == sorted(firsts):
            valid.append(tokens)
    if not valid:
        return set()
    # the class of most tags, with one occurrence a page, is the frame that the others are nested in
    single = [v for v in valid if len(places[v[0]]) == 1]
    tags = lambda v: sum(nodes[places[t][0]].kind != "text" for t in v)
    frame = max((v for v in single if tags(v)), key=lambda v: (tags(v), len(v), -places[v[0]][0]), default=[])
    edges = sorted(places[t][0] for t in frame)
    out = set(frame)
    for tokens in valid:
        if tokens is frame:
            continue
        slots = [{bisect(edges, places[t][k]) for t in tokens} for k in range(len(places[tokens[0]]))]
        if all(len(s) == 1 for s in slots):
            out.update(tokens)
    return out


def main_text(html: str | None, template=None) -> str:
    """Blocks of the slots that hold the article, joined by an empty line."""
    nodes = parse(html or "")
    fixed = template_tokens([n for n in nodes if n.kind != "text" or n.text.strip()], template)
    slot = lambda n: n.kind == "text" and not n.dropped and n.token not in fixed and n.text.strip() != ""
    # an article in little of the marked text is not the page's own
    sizes = Counter()
    for n in nodes:
        if slot(n):
            sizes[n.main] += len(n.text.strip())
    best = max((m for m in sizes if m), key=lambda m: (sizes[m], m), default=0)
    blocks: list[str] = []
    # texts of the current block, and whether each is template
    words: list[tuple[str, bool]] = []

    def end_block() -> None:
        # fixed words within a sentence are part of it; a block of nothing else is template
        if not all(is_fixed for text, is_fixed in words if text.strip()):
            blocks.append(" ".join("".join(text for text, _ in words).split()))
        words.clear()

    for node in nodes:
        name = node.name.partition("[")[0]
        if node.kind == "text":
            if node.main >= best and not node.dropped:
                words.append((node.text, node.token in fixed))
        elif name in BLOCKS:
            end_block()
        elif name in CELLS:
            words.append((" ", False))
    end_block()
    return "\n\n".join(b for b in blocks if b)


def _packed(batches):
    for batch in batches:
        yield pd.DataFrame({
            "page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "host": [host_of(u) for u in batch["url"]],
            "packed": [zlib.compress((h or "").encode(), 1) for h in batch["html"]],
        })


def _extracted(shared):
    def extract(batches):
        common = shared.value
        for batch in batches:
            rows = []
            for page, url, packed, template in zip(batch["page_id"], batch["url"], batch["packed"], batch["template"]):
                rows.append((page, url, main_text(zlib.decompress(packed).decode(), template if template is not None else common)))
            out = pd.DataFrame(rows, columns=["page_id", "url", "text"])
            yield out.assign(page_id=out["page_id"].astype("Int64"))

    return extract


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_tokens: int = MIN_TOKENS,
    fixed_text_pages: int = FIXED_TEXT_PAGES, salts: int = SALTS, own_share: float = OWN_SHARE,
) -> DataFrame:
    """`page_id, url, text, n_chars` for each row of `pages`.

    A host's pages never meet in one task: their tokens are summed before the shuffle, and the
    template, a row a host, is joined back to salted pages. A text that stands on every page of a
    template is itself template if there are at least `fixed_text_pages` of them with differing other
    texts, which have `own_share` of the characters of the template's texts. Defined results: a
    null or empty html gives an empty text; a null id or URL stays null, and the pages without a host
    are one host; repeated rows are a page each; an empty table gives no rows; other columns are not
    read.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    schema = "host string, token bigint, is_text boolean, level int, n bigint, one bigint, two bigint, place bigint"
    sums = [F.sum(c).alias(c) for c in ("n", "one", "two", "place")] + [F.max("level").alias("level")]
    tokens = rows.mapInPandas(_occurrences, schema).groupBy("host", "token", "is_text").agg(F.count(F.lit(1)).alias("pages"), *sums)
    # a token of one page alone is in no class
    tokens = written(tokens.where(f"pages >= {min(2, min_pages)} or token = 0"), "page-tokens")
    options = (min_pages, min_share, min_tokens, fixed_text_pages)
    of_host = tokens.where("token = 0").select("host", F.col("pages").alias("of_host"))
    classes = written(_classes(tokens.join(of_host, "host"), *options), "page-classes")
    # classes over all pages: at most 1 / min_share times as many tokens as a page has on average
    pooled = tokens.groupBy("token", "is_text").agg(F.sum("pages").alias("pages"), *sums)
    n_pages = of_host.agg(F.sum("of_host")).first()[0] or 0
    pooled = pooled.withColumns({"host": F.lit(""), "of_host": F.lit(n_pages)})
    pooled_classes = written(_classes(pooled, *options), "pooled-classes")
    spark = pages.sparkSession

    def broadcast(found: DataFrame):
        common = [r["template"] for r in _of_hosts(found).collect()]
        return spark.sparkContext.broadcast([e.asDict() for e in common[0]] if common else [])

    def with_template(df: DataFrame, templates: DataFrame, *key: str) -> DataFrame:
        spread_templates = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return df.withColumn("salt", spread(*key, over=salts)).join(spread_templates, ["host", "salt"], "left")

    # texts are compared where a class has any that can be kept
    texts = rows.mapInPandas(_texts, "host string, tokens array<bigint>, chars array<int>, levels array<int>")
    of_texts = _of_hosts(classes.where(F.exists("tokens", lambda t: t["level"] >= 0)))
    recurring = written(_recurring(
        with_template(texts, of_texts, "tokens").mapInPandas(
            _beside(broadcast(pooled_classes)), "host string, class bigint, level int, own bigint, own_chars bigint, class_chars bigint"
        ), fixed_text_pages, own_share,
    ), "page-recurring")
    templates = _of_hosts(_with_recurring(classes, recurring.where("host is not null"), ["host", "class"]))
    shared = broadcast(_with_recurring(pooled_classes, recurring.where("host is null").drop("host"), ["class"]))
    packed = rows.mapInPandas(_packed, "page_id bigint, url string, host string, packed binary")
    joined = with_template(packed, templates, "page_id", "url").select("page_id", "url", "packed", "template")
    return joined.mapInPandas(_extracted(shared), "page_id bigint, url string, text string").withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
