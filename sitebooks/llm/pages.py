"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import html
import re
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitebooks.llm.common import map_text
from sitebooks.runtime import materialise

#: A slot is template if one text of it is on at least so many distinct pages of a host and on at least this share of them all.
PAGES, REPEATED = 4, 0.5
#: A block is template, also in an article, if its text is in its slot on at least this share of the distinct pages.
CONSTANT = 0.8
#: Bytes of wrappers that may be sent to all tasks; beyond them the pages are joined by host.
SENT = 32 << 20
#: Levels of a tree that are told apart.
DEPTH = 60
#: Articles with less than this share of a page's text are no main text by themselves.
SMALL = 0.25

#: Other '<' are text, as in "i<n)".
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:._-]*)(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:._-]*)(?=[\s/>])([^>]*)>""",
    re.S,
)
#: What may stand behind the last '>' and is no text.
UNCLOSED = re.compile(r"<!--|<!\[CDATA\[")
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "xmp", "noscript", "iframe", "template")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr nobr picture source area map object param embed".split()
)
#: An open element that a start tag ends by itself.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
BOUND = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Never main text, wherever they stand; outside an article also headers.
NEVER = frozenset(
    "nav footer aside script style noscript template menu dialog button select textarea iframe svg canvas head title "
    "object audio video map figure-ad".split()
)
MAIN = frozenset(("article", "main"))
APART = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|menu\w*|nav\w*|breadcrumbs?|side-?bar\w*|foot(?:er)?|"
    r"(?:site|page|top)-?header|masthead|cookies?|consent|gdpr|notices?|alerts?|pop-?up|modal|overlay|newsletter|subscri\w*|"
    r"shar(?:e|ing)|social|related|recommend\w*|comments?|commentlist|disqus|repl(?:y|ies)|respond|login|sign-?up|search\w*|"
    r"widgets?|pagination|pager|copyright)(?:$|[\s_-])",
    re.I,
)
#: Class words that tell of a page's state or subject, not of what the element is.
STATE = re.compile(
    r"(?:has|no|non|not|with|without|hide|show|category|tag|type|format|status|term|author)[_-].*|.*[_-](?:opened|open|closed|close|enabled|disabled|active|on|off)",
    re.I | re.S,
)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|repl(?:y|ies)|respond)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert".split())
#: Marks of an element: what is APART or a form may yet hold the page's main text, what is NEVER may not.
PLAIN, FORM, BESIDE, REMARKS, BARRED = range(5)
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)


class Page:
    """Text blocks of a page with their slots, and its folded tree.

    A slot is the path of element labels (tag with first class or id, digits
    dropped) from the root; siblings with one label are one node of the folded
    tree, so lists and paragraphs of any number give the same tree.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[tuple[str, ...], int, str]] = []  # slot, spot, text
        #: Elements with a mark or of main, each after the one around it (-1: none): around, is main, in main, mark, barred.
        self.spots: list[tuple[int, bool, bool, int, bool]] = []
        self.tree: dict = {}
        stack: list[tuple[str, str, int]] = []  # tag, label, spot
        places: dict[str, list[int]] = {}  # where each tag is on the stack
        words: list[str] = []
        at, end, last = 0, len(source), source.rfind(">")

        def highest(tags) -> int:
            """The place of the innermost open element with one of the tags, -1 if there is none."""
            return max([places[t][-1] for t in tags if places.get(t)], default=-1)

        def shut(place: int):
            """End an element and all in it."""
            for tag, _, _ in stack[place:]:
                places[tag].pop()
            del stack[place:]

        def flush():
            if words:
                text = " ".join(html.unescape("".join(words)).split())
                words.clear()
                if text:
                    slot = tuple(s[1] for s in stack[:DEPTH])
                    self.blocks.append((slot, stack[-1][2] if stack else -1, text))

        while at < end:
            m = TOKEN.search(source, at) if at <= last else UNCLOSED.search(source, at)
            if m and at > last:  # no tag can end any more, and an open comment takes the rest
                words.append(source[at : m.start()])
                break
            if m is None:
                words.append(source[at:])
                break
            if m.start() > at:
                words.append(source[at : m.start()])
            at = m.end()
            close, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                continue
            tag = tag.lower()
            if tag == "br":
                words.append(" ")
                continue
            if tag in INLINE:
                continue
            flush()
            if close:
                place = highest((tag,))
                if place > (highest(MAIN) if tag in ("p", "li", "div", "span") else -1):
                    shut(place)
                continue
            if tag in PARAGRAPH_ENDS and (place := highest(("p",))) > highest(("td", "th", "button", "object")):
                shut(place)
            if tag in ENDS and (place := highest(ENDS[tag])) > highest(BOUND.get(tag, ())):
                shut(place)
            if tag in VOID:
                continue
            spot = stack[-1][2] if stack else -1
            inside = spot >= 0 and self.spots[spot][2]
            label, main, mark = tag, tag in MAIN, FORM if tag == "form" else PLAIN
            if rest and not rest.isspace():
                found: dict[str, str] = {}
                for a in ATTRIBUTE.finditer(rest):
                    found.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
                name = found.get("class", "").split()[:1] or found.get("id", "").split()[:1]
                if name:
                    label = f"{tag}.{re.sub(r'[^A-Za-z_-]+', '', name[0])}"
                role = found.get("role", "").lower()
                main |= role == "main" or "articleBody" in found.get("itemprop", "")
                if tag not in ("html", "body"):
                    words_of = [w for a in ("class", "id") for w in found.get(a, "").split() if APART.search(w) and not STATE.fullmatch(w)]
                    if words_of:
                        mark = REMARKS if any(map(COMMENTS.search, words_of)) else BESIDE
                    elif role == "form":
                        mark = FORM
                    if role in ROLES or "hidden" in found:
                        mark = BARRED
            if tag in NEVER or (tag == "header" and not (main or inside)):
                mark = BARRED
            if tag in RAW:
                over = RAW[tag].search(source, at)
                at = over.end() if over else end
                continue
            if main or mark:
                barred = mark == BARRED or (spot >= 0 and self.spots[spot][4])
                self.spots.append((spot, main, main or inside, mark, barred))
                spot = len(self.spots) - 1
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, label, spot))
            node = self.tree
            for s in stack[:DEPTH]:
                node = node.setdefault(s[1], {})
        flush()

    def skeleton(self) -> str:
        return folded(self.tree)

    def around(self, spot: int):
        """The spots from one outwards."""
        while spot >= 0:
            yield spot
            spot = self.spots[spot][0]

    def barred(self, spot: int) -> bool:
        return spot >= 0 and self.spots[spot][4]

    def apart(self, varies: list[bool]) -> list[bool]:
        """For each block, whether it stands in an element that is not content.

        A class word or a form says so, but not for an element that holds the
        page's article, or, where there is none, most of its varying text
        (lists of comments may be long, so they stay apart).
        """
        marks = [s[3] for s in self.spots]
        own, whole, total, plain = [0] * len(marks), [0] * len(marks), 0, 0
        for (_, spot, text), new in zip(self.blocks, varies):
            if self.barred(spot):
                continue
            n = len(text)
            total += n if new else 0
            if spot < 0:
                plain += n
            else:
                own[spot] += n
                whole[spot] += n if new else 0
        for s in range(len(marks) - 1, -1, -1):  # an element comes behind the one around it
            outer, n = self.spots[s][0], 0 if marks[s] > FORM else own[s]  # without what is beside an article in there
            if outer < 0:
                plain += n
            else:
                own[outer] += n
                whole[outer] += whole[s]
        free: set[int] = set()
        above: list[int] = []
        for s, spot in enumerate(self.spots):
            above.append((above[spot[0]] if spot[0] >= 0 else 0) + (marks[s] > FORM))
        articles = [(-above[s], own[s], -s) for s, spot in enumerate(self.spots) if spot[1] and own[s]]
        if articles:
            beside, size, s = max(articles)
            if not beside or size >= SMALL * plain:
                free.update(self.around(-s))
        if not free:
            free.update(s for s, mark in enumerate(marks) if mark in (FORM, BESIDE) and 2 * whole[s] > total)
        out = {-1: False}
        for s, mark in enumerate(marks):
            out[s] = out[self.spots[s][0]] or mark == BARRED or (mark > PLAIN and s not in free)
        return [out[spot] for _, spot, _ in self.blocks]


def folded(tree: dict) -> str:
    """The folded tree as text: label(children)..."""
    return "".join(f"{label}({folded(below)})" for label, below in tree.items())


@lru_cache(4096)
def unfolded(text: str) -> tuple:
    """Nodes (label, children) of a folded tree."""
    stack: list[list] = [[]]
    for part in re.finditer(r"([^()]+)\(|\)", text):
        if part[1]:
            stack[-1].append([part[1], []])
            stack.append(stack[-1][-1][1])
        else:
            stack.pop()
    freeze = lambda nodes: tuple((n, freeze(kids)) for n, kids in nodes)
    return freeze(stack[0])


def match(one: tuple, two: tuple, memo: dict) -> tuple[int, list]:
    """Simple tree matching of two child lists: size of the largest matching in order, and its pairs."""
    key = (id(one), id(two))
    if key in memo:
        return memo[key][:2]
    # Siblings of a folded tree have different labels, so each has one partner at most: the
    # largest matching in order is a heaviest rising sequence of partners' places.
    place = {label: j for j, (label, _) in enumerate(two)}
    found = [(i, place[label]) for i, (label, _) in enumerate(one) if label in place]
    rank = {j: r for r, j in enumerate(sorted(j for _, j in found), 1)}
    heavy = [(0, -1)] * (len(found) + 1)  # by rank, as a tree of prefix maxima: weight and last pair of the best sequence
    before = []
    for k, (i, j) in enumerate(found):
        best, r = (0, -1), rank[j] - 1
        while r:
            best = max(best, heavy[r], key=lambda x: x[0])
            r &= r - 1
        before.append(best[1])
        now, r = (best[0] + 1 + match(one[i][1], two[j][1], memo)[0], k), rank[j]
        while r < len(heavy):
            heavy[r] = max(heavy[r], now, key=lambda x: x[0])
            r += r & -r
    total, k, r = 0, -1, len(found)
    while r:
        if heavy[r][0] > total:
            total, k = heavy[r]
        r &= r - 1
    pairs = []
    while k >= 0:
        pairs.append(found[k])
        k = before[k]
    memo[key] = (total, pairs[::-1], one, two)
    return memo[key][:2]


@lru_cache(4096)
def aligned(page: str, reference: str) -> dict[str, str]:
    """Slots of a page's folded tree that simple tree matching pairs with slots of the reference tree."""
    memo, out = {}, {}
    todo = [(unfolded(page), unfolded(reference), "", "")]
    while todo:
        one, two, a, b = todo.pop()
        for i, j in match(one, two, memo)[1]:
            x, y = f"{a}/{one[i][0]}", f"{b}/{two[j][0]}"
            out[x] = y
            todo.append((one[i][1], two[j][1], x, y))
    return out


def name(slot: tuple[str, ...]) -> str:
    return "".join(f"/{label}" for label in slot)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


#: ``whole``: the text of the slot; ``part``: a block of it.  A slot of one block is both.
SLOTS = T.ArrayType(
    T.StructType(
        [T.StructField("slot", T.StringType()), T.StructField("hash", T.LongType())]
        + [T.StructField(n, T.BooleanType()) for n in ("whole", "part")]
    )
)


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def surveyed(pages: DataFrame) -> DataFrame:
    """``host``, folded tree, hashes of each slot's text and blocks, one hash of all texts (``page``) of every page."""

    def start():
        def fn(sources):
            trees, slots, whole = [], [], []
            for s in sources.to_pylist():
                page = Page(s or "")
                texts: dict[str, list[str]] = {}
                for slot, spot, text in page.blocks:
                    if not page.barred(spot):
                        texts.setdefault(name(slot), []).append(text)
                trees.append(page.skeleton())
                rows = []
                for k, v in texts.items():
                    rows.append({"slot": k, "hash": digest("\n".join(v)), "whole": True, "part": len(v) == 1})
                    if len(v) > 1:
                        rows += [{"slot": k, "hash": digest(t), "whole": False, "part": True} for t in dict.fromkeys(v)]
                slots.append(rows)
                whole.append(digest("\n".join(f"{s['slot']} {s['hash']}" for s in rows if s["whole"])))
            kind = pa.list_(pa.struct([("slot", pa.string()), ("hash", pa.int64()), ("whole", pa.bool_()), ("part", pa.bool_())]))
            return [pa.array(trees, pa.string()), pa.array(slots, kind), pa.array(whole, pa.int64())]

        return fn

    fields = [T.StructField("tree", T.StringType()), T.StructField("slots", SLOTS), T.StructField("page", T.LongType())]
    return map_text(pages, "html", ["host"], fields, start)


def wrappers(seen: DataFrame, least_pages: int = PAGES, repeated: float = REPEATED, constant: float = CONSTANT) -> DataFrame:
    """``host``, its most frequent folded tree, and the slots and blocks (slot and hash) of it that are template.

    All distinct pages of a host count, copies once.  Trees other than the
    reference are aligned with it; a slot's texts are counted with partial
    sums, so a host of very many pages is no hot key.  A slot is template if
    one text of it is on ``repeated`` of the host's distinct pages, a block if
    its text is in the slot on ``constant`` of them.
    """
    seen = seen.groupBy("host", "tree", "page").agg(F.first("slots").alias("slots"))  # equal in all copies
    trees = seen.groupBy("host", "tree").agg(F.count("*").alias("n"))
    reference = trees.groupBy("host").agg(F.max_by("tree", F.struct("n", "tree")).alias("reference"))
    texts = (
        seen.select("host", "tree", F.explode("slots").alias("s"))
        .groupBy("host", F.xxhash64("tree").alias("key"), "s.slot", "s.hash")
        .agg(F.count_if("s.whole").alias("n"), F.count_if("s.part").alias("parts"))
    )
    pairs = trees.select("host", "tree").join(reference, "host")

    def align(batches):
        for batch in batches:
            rows = [
                (h, t, x, y)
                for h, t, r in zip(*(c.to_pylist() for c in batch.columns))
                for x, y in aligned(t, r).items()
            ]
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["host", "tree", "slot", "ref"])

    same = pairs.mapInArrow(align, "host string, tree string, slot string, ref string")
    same = same.select("host", F.xxhash64("tree").alias("key"), "slot", "ref")
    counted = texts.join(same, ["host", "key", "slot"]).groupBy("host", "ref", "hash")
    counted = counted.agg(F.sum("n").alias("n"), F.sum("parts").alias("parts"))
    total = trees.groupBy("host").agg(F.sum("n").alias("pages"))
    often = counted.where(F.greatest("n", "parts") >= least_pages).join(total, "host")
    found = F.array(
        F.when(F.col("n") >= F.greatest(F.lit(least_pages), repeated * F.col("pages")), F.col("ref")),
        F.when(
            F.col("parts") >= F.greatest(F.lit(least_pages), constant * F.col("pages")),
            F.concat_ws(" ", "ref", F.col("hash").cast("string")),
        ),
    )
    fixed = often.select("host", F.explode(F.array_compact(found)).alias("ref"))
    fixed = fixed.groupBy("host").agg(F.array_sort(F.collect_set("ref")).alias("template"))
    return reference.join(fixed, "host", "left").select(
        F.col("host").alias("__host"), "reference", F.coalesce("template", F.array().cast("array<string>")).alias("template")
    )


def main_text(source: str, reference: str | None, template: set[str]) -> str:
    """Texts of the slots that vary, in page order.

    Slots and blocks that the host's wrapper shows to be template go; in an
    article only blocks do, and none if less than half of its text would stay
    (pages may be near copies).  Then the elements are checked: menus, footers,
    forms and the like are never content, save those around the main text
    (:meth:`Page.apart`); where articles hold a fair share of the varying text
    (:data:`SMALL`), text outside them goes.
    """
    page = Page(source)
    same = aligned(page.skeleton(), reference) if reference else {}
    main = [spot >= 0 and page.spots[spot][2] for _, spot, _ in page.blocks]
    paths = [same.get(path, path) for path in (name(slot) for slot, _, _ in page.blocks)]
    varies = [
        not template or ((m or path not in template) and f"{path} {digest(text)}" not in template)
        for path, m, (_, _, text) in zip(paths, main, page.blocks)
    ]
    never = page.apart(varies)
    size = lambda wanted: sum(len(b[2]) for b, w in zip(page.blocks, wanted) if w)
    article = [m and not n for m, n in zip(main, never)]
    if 2 * size(a and v for a, v in zip(article, varies)) < size(article):
        varies = [v or a for v, a in zip(varies, article)]
    inner = size(a and v for a, v in zip(article, varies))
    outer = size(v and not (m or n) for v, m, n in zip(varies, main, never))
    lead = inner > 0 and inner >= SMALL * (inner + outer)
    return "\n".join(b[2] for b, v, n, m in zip(page.blocks, varies, never, main) if v and not n and (m or not lead))


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    The pages of a host are compared first: the most frequent folded tree is
    the reference, others are aligned with it by simple tree matching, and
    slots with one text on most distinct pages of the host, and blocks on nearly
    all, become template (:func:`wrappers`).  Then each page is aligned with its host's wrapper and
    the varying slots are its content, one line per block.

    Wrappers go to all tasks when they are small (:data:`SENT` bytes); else pages
    are joined with them by host, where adaptive execution splits a large host.
    Null or empty html gives an empty text; a null or odd url counts as the
    host with the empty name; repeated rows are rows of their own, but count as
    one page of the host; an empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).cast("string").alias("html"), host(F.col(url)).alias("host")
    )
    seen = materialise(surveyed(rows.select("host", "html")), "page-slots")
    found = materialise(wrappers(seen), "page-wrappers")
    size = F.octet_length("__host") + F.octet_length("reference") + F.octet_length(F.array_join("template", ",")) + 100
    few = found.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= SENT
    joined = rows.join(F.broadcast(found) if few else found, F.col("host") == F.col("__host"), "left")
    wrapper = F.struct("reference", "template")
    source_rows = joined.select("html", "page_id", "url", wrapper.alias("wrapper"))
    head = source_rows.schema
    schema = T.StructType([head["page_id"], head["url"], T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])

    def run(batches):
        sets: dict[tuple, set] = {}
        for batch in batches:
            texts = []
            references = batch.column(3).field("reference").to_pylist()
            templates = batch.column(3).field("template").to_pylist()
            for s, reference, template in zip(batch.column(0).to_pylist(), references, templates):
                key = tuple(template or ())
                texts.append(main_text(s or "", reference, sets.setdefault(key, set(key))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
            )

    return source_rows.mapInArrow(run, schema)
