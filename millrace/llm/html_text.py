"""Main text of web pages by templates deduced from equivalence classes.

Tokens are tags and text segments, told apart by the path of open elements above them. Tokens of a host that
occur equally often on each of its pages share an occurrence vector; those that share one form an
equivalence class, the trace of one constructor of the host's template. Vectors are compared by two sums over pages
(count times a hash of the page), which map tasks add up, so a host with a third of all pages is counted like any other.
A class is valid when its tokens come in one order on all pages, cycle by cycle, and when it lies in one gap of the
classes around it; overlapping classes lose to the larger one. The nested valid classes are the template.

A page is read along its host's template. A tag whose own path is broken, as below an element that was never
closed, takes the path that the template gives it. What lies between template tokens are slots; those below
menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments are left out, template
text is no content, and the remaining slots are the text. A host with too few pages has no template;
its pages are read along their own tags.
"""

from __future__ import annotations

import html
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import stage_table

MIN_PAGES = 3  # of a host, for a template
MIN_SHARE = 0.3  # of a host's pages on which a template token occurs
MIN_TOKENS = 3  # of a class
TEXT_PAGES = 10  # of a host, before repeated text counts as template
BROADCAST_BYTES = 64 << 20
PRIME = (1 << 61) - 1

# Fixed: HTML elements by what they do to the flow of text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small "
             "span strike strong sub sup time tt u var wbr".split())
RAW = set("script style textarea title noscript iframe xmp".split())
HEAD = set("head title meta link script style base noscript template".split())
IN_TEXT = INLINE | HEAD - {"head"}  # do not end a block
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
             "option": ({"option"}, {"select", "datalist"})}
# Chosen here: elements, and words of class or id, that never hold main text.
DROPPED = set("nav footer aside form head script style noscript template iframe object svg canvas audio video button select "
              "textarea dialog menu title".split())
COMMENTS = set("comment comments commentlist disqus respond replies reactions".split())
AROUND = set("ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
             "notice notices alert popup modal sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead share "
             "sharing social related recommended newsletter subscribe subscription signup pagination pager toolbar widget legal "
             "copyright".split())
TITLES = set("header topbar".split())  # boilerplate outside the article only
MAIN = {"article", "main"}

OUTSIDE, INSIDE, SOFT, HARD = range(4)  # of the article; of something left out that an article may end; that nothing ends

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<attrs>(?:\s++|/|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+)(?:>|\Z)", re.S)
MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
WORDS = re.compile(r"[a-z]+")
RUNS = re.compile(r"\d+")
NAME_END = re.compile("[.#@]")
NO_MARK = re.compile("[/<\x01]")  # these part a label


class Walk:
    """The tokens of a page: ``(kind, label, signature, text)`` with kind ``<``, ``/`` or ``t``.

    ``known`` holds the labels of the template, ``places`` the path of each signature that has only one there.
    Open elements follow the rules of HTML for tags that are left out; tags of inline elements are tokens but open nothing.
    """

    def __init__(self, page: str, places: dict[str, list[str]] | None = None, known: set[str] = frozenset()):
        self.page, self.places, self.known = page, places or {}, known
        self.names: list[str] = []  # open elements
        self.marks: list[str] = []  # and their signatures

    def path(self) -> str:
        return "/".join(self.marks)

    def pop_to(self, depth: int) -> None:
        del self.names[depth:], self.marks[depth:]

    def imply_ends(self, name: str) -> None:
        if name == "body" or (name not in HEAD and "head" in self.names):
            if "head" in self.names:
                self.pop_to(self.names.index("head"))
        closed, scope = CLOSED_BY.get(name, ((), ()))
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] in scope:
                break
            if self.names[depth] in closed:
                self.pop_to(depth)
        if name not in IN_TEXT:
            while self.names and self.names[-1] == "p":
                self.pop_to(len(self.names) - 1)

    def place(self, kind: str, mark: str) -> str:
        """The label of a tag here; a path that the template knows better replaces the open elements."""
        label = f"{self.path()}{kind}{mark}"
        if label not in self.known and (better := self.places.get(kind + mark)) is not None:
            self.marks = list(better)
            self.names = [NAME_END.split(m, maxsplit=1)[0] for m in better]
            label = f"{self.path()}{kind}{mark}"
        return label

    def __iter__(self) -> Iterator[tuple[str, str, str, str]]:
        page, at, end = self.page, 0, len(self.page)
        while at < end:
            found = TAG.search(page, at)
            if found is None:
                yield "t", self.path(), "", page[at:]
                return
            if found.start() > at:
                yield "t", self.path(), "", page[at:found.start()]
            at = found.end()
            name = (found["name"] or "").lower()
            if not name:
                continue
            if found["end"]:
                if name in INLINE or name in VOID:
                    yield "/", f"{self.path()}/{name}", name, ""
                    continue
                if name in self.names:
                    depth = len(self.names) - 1 - self.names[::-1].index(name)
                    mark = self.marks[depth]
                    self.pop_to(depth)
                    yield "/", self.place("/", mark), mark, ""
                continue
            attrs = {}
            for m in MARKS.finditer(found["attrs"]):
                attrs.setdefault(m[1].lower(), " ".join(sorted((m[2] or m[3] or m[4] or "").lower().split())))
            mark = name + "".join(f"{sign}{RUNS.sub('0', attrs[k])}" for k, sign in
                                  (("class", "."), ("id", "#"), ("role", "@")) if attrs.get(k))
            mark = NO_MARK.sub(" ", mark)
            self.imply_ends(name)
            label = self.place("<", mark)
            if name not in VOID and name not in INLINE:
                self.names.append(name)
                self.marks.append(mark)
            yield "<", label, mark, ""
            if name in RAW:  # up to its end tag there are no tags
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>|</{name}\Z", re.I).search(page, at)
                at = close.end() if close else end
                self.pop_to(len(self.names) - 1)


def clean(text: str) -> str:
    """Character references decoded, white space as one blank, none at the ends."""
    return " ".join(html.unescape(text).split())


def _text_label(path: str, text: str) -> str:
    return f"{path}\x01{xxhash.xxh3_128_hexdigest(text)}"


def page_tokens(page: str) -> list[str]:
    """The labels of a page in order, text by its hash."""
    out = []
    for kind, label, _, text in Walk(page):
        if kind != "t":
            out.append(label)
        elif text := clean(text):
            out.append(_text_label(label, text))
    return out


def _keep(state: int, name: str, mark: str) -> int:
    """What an element makes of its content."""
    if state == HARD or name in DROPPED:
        return HARD
    words = set(WORDS.findall(mark[len(name):])) if name not in ("html", "body") else set()
    if words & COMMENTS:
        return HARD
    if name in MAIN or "@main" in mark:
        return INSIDE
    if words & AROUND or (state != INSIDE and (name in TITLES or words & TITLES)):
        return SOFT
    return state


def extract(page: str, template: dict | None = None) -> str:
    """The main text of one page, blocks joined by two line feeds."""
    template = template or {}
    texts = template.get("texts", ())
    walk = Walk(page, template.get("places"), template.get("tags", ()))
    blocks: dict[int, list[str]] = {OUTSIDE: [], INSIDE: []}
    held: list[str] = []
    states, seen = [], []  # of the open elements, by their signatures
    now = OUTSIDE

    def state() -> int:
        same = 0
        while same < min(len(seen), len(walk.marks)) and seen[same] == walk.marks[same]:
            same += 1
        del states[same:], seen[same:]
        for name, mark in zip(walk.names[same:], walk.marks[same:]):
            states.append(_keep(states[-1] if states else OUTSIDE, name, mark))
            seen.append(mark)
        return states[-1] if states else OUTSIDE

    def end_block() -> None:
        if block := clean("".join(held)):
            blocks[now].append(block)
        held.clear()

    for kind, label, mark, text in walk:
        if kind == "t":
            here = state()
            if here in blocks and not (texts and _text_label(label, clean(text)) in texts):
                now = here
                held.append(text)
        elif NAME_END.split(mark, maxsplit=1)[0] == "br":
            held.append(" ")
        elif NAME_END.split(mark, maxsplit=1)[0] not in IN_TEXT:
            end_block()
    end_block()
    return "\n\n".join(blocks[INSIDE] or blocks[OUTSIDE])


def _host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def _by_host(pages: DataFrame) -> DataFrame:
    return pages.select(_host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"),
                        F.xxhash64("page_id", "url", "html").alias("page"))


def token_vectors(pages: DataFrame) -> DataFrame:
    """host, token, f1, f2, pages, total: two sums that tell occurrence vectors apart, and where a token occurs.

    The empty token occurs once on every page.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0, 0, 0])
            for host, page, number in zip(*(c.to_pylist() for c in batch.columns)):
                counts: dict[str, int] = defaultdict(int)
                for token in page_tokens(page):
                    counts[token] += 1
                counts[""] = 1
                h1, h2 = (number & 0x7FFFFFFF) + 1, (number >> 33 & 0x7FFFFFFF) + 1
                for token, n in counts.items():
                    entry = sums[host, token]
                    entry[0] = (entry[0] + n * h1) % PRIME
                    entry[1] = (entry[1] + n * h2) % PRIME
                    entry[2] += 1
                    entry[3] += n
            keys, values = list(sums), np.array(list(sums.values()), np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 *(pa.array(values[:, i]) for i in range(4))], names=["host", "token", "f1", "f2", "pages", "total"])

    rows = _by_host(pages).mapInArrow(count, "host string, token string, f1 long, f2 long, pages long, total long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    return rows.groupBy("host", "token").agg(wide("f1"), wide("f2"), F.sum("pages").alias("pages"),
                                             F.sum("total").alias("total"))


def equivalence_classes(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
                        min_tokens: int = MIN_TOKENS) -> DataFrame:
    """host, n_pages, class, tokens: large, frequent classes of tokens with one occurrence vector.

    A token has to occur on a share of its host's pages, so a host's classes are bounded by the size of its pages.
    """
    vectors = stage_table(token_vectors(pages), "vectors")
    hosts = vectors.where((F.col("token") == "") & (F.col("pages") >= min_pages)).select(
        "host", F.col("pages").alias("n_pages"))
    often = vectors.where((F.col("token") != "") & (F.col("pages") >= min_pages)).join(hosts, "host").where(
        F.col("pages") >= min_share * F.col("n_pages"))
    classes = often.groupBy("host", "n_pages", "f1", "f2", "pages", "total").agg(
        F.sort_array(F.collect_list("token")).alias("tokens")).where(F.size("tokens") >= min_tokens)
    return classes.select("host", "n_pages", F.concat_ws("|", "f1", "f2", "pages", "total").alias("class"), "tokens")


def _order(sequence: list[int], size: int) -> list[int] | None:
    """The order of one cycle, if the tokens of a class come in whole equal cycles."""
    first = sequence[:size]
    if len(set(first)) != size or len(sequence) % size or sequence != first * (len(sequence) // size):
        return None
    return first


def _gap(inner: list[int], size: int, outer: np.ndarray, outer_size: int) -> int:
    """The gap of the outer class that holds all cycles of the inner one; 0 around its cycles, -1 if there is none."""
    starts = np.searchsorted(outer, inner[::size])
    if (starts != np.searchsorted(outer, inner[size - 1::size])).any():
        return -1
    gaps = np.unique(starts % outer_size)
    return int(gaps[0]) if len(gaps) == 1 else -1


def page_signatures(page: str, classes: list[list[str]]) -> Iterator[tuple[int, int, str]]:
    """``(class, -1, order)`` of each class on a page and ``(class, other, gap)`` of each pair in order; ``!`` where invalid."""
    of = {t: (c, i) for c, tokens in enumerate(classes) for i, t in enumerate(tokens)}
    places, sequences = defaultdict(list), defaultdict(list)
    for at, token in enumerate(page_tokens(page)):
        if token in of:
            c, i = of[token]
            places[c].append(at)
            sequences[c].append(i)
    good = []
    for c, sequence in sequences.items():
        order = _order(sequence, len(classes[c]))
        yield c, -1, "!" if order is None else ",".join(map(str, order))
        if order is not None:
            good.append(c)
    arrays = {c: np.array(places[c]) for c in good}
    for c in good:
        for d in good:
            if c != d:
                gap = _gap(places[c], len(classes[c]), arrays[d], len(classes[d]))
                yield c, d, "!" if gap < 0 else str(gap)


def deduce_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
                     min_tokens: int = MIN_TOKENS) -> DataFrame:
    """host, n_pages, class, tokens (in template order), parent (class or null), gap: the nested valid classes of each host.

    ``gap`` is the token of the parent (from 1) after which the class stands.
    """
    classes = stage_table(equivalence_classes(pages, min_pages, min_share, min_tokens), "classes")
    per_host = classes.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("class", "tokens"))).alias("classes"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str, str], list[str]] = {}
            for host, page, listed in zip(*(c.to_pylist() for c in batch.columns)):
                named = json.loads(listed)
                for c, d, mark in page_signatures(page, [x["tokens"] for x in named]):
                    key = host, named[c]["class"], "" if d < 0 else named[d]["class"]
                    least, most = found.setdefault(key, [mark, mark])
                    found[key] = [min(least, mark), max(most, mark)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.string()) for x in ([k[0] for k in found], [k[1] for k in found], [k[2] for k in found],
                                                          [v[0] for v in found.values()], [v[1] for v in found.values()])],
                names=["host", "class", "other", "least", "most"])

    told = _join_by_host(_by_host(pages).select("host", "html"), per_host.select("host", F.to_json("classes").alias("listed")),
                         "listed", "inner")
    marks = told.mapInArrow(sign, "host string, class string, other string, least string, most string").groupBy(
        "host", "class", "other").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    agreed = F.when((F.col("least") == F.col("most")) & (F.col("least") != "!"), F.col("least"))
    marks = stage_table(marks.select("host", "class", "other", agreed.alias("mark")), "signatures")
    ordered = marks.where("other = '' AND mark IS NOT NULL").join(classes, ["host", "class"]).select(
        "host", "class", "n_pages", F.size("tokens").alias("size"),
        F.transform(F.split("mark", ","), lambda i: F.element_at("tokens", i.cast("int") + 1)).alias("tokens"))
    sized = ordered.select("host", "class", "size")
    pairs = marks.where("other != ''").join(sized, ["host", "class"]).join(
        sized.select("host", F.col("class").alias("other"), F.col("size").alias("other_size")), ["host", "other"])
    both = pairs.groupBy("host", F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).agg(
        F.count("mark").alias("fit"), F.max(F.struct(F.when(F.col("class") < F.col("other"), F.col("size")).otherwise(
            F.col("other_size")).alias("a"), F.when(F.col("class") < F.col("other"), F.col("other_size")).otherwise(
            F.col("size")).alias("b"))).alias("sizes"))
    lost = both.where("fit = 0").select("host", F.when(F.col("sizes.a") < F.col("sizes.b"), F.col("a")).otherwise(
        F.col("b")).alias("class")).distinct()
    kept = ordered.join(lost, ["host", "class"], "left_anti")
    inside = pairs.where("mark IS NOT NULL AND mark != '0'").select("host", "class", "other", "mark").join(
        lost, ["host", "class"], "left_anti").join(
        lost.select("host", F.col("class").alias("other")), ["host", "other"], "left_anti")
    depth = inside.groupBy("host", "class").agg(F.count(F.lit(1)).alias("depth"))
    parents = inside.join(depth.select("host", F.col("class").alias("other"), "depth"), ["host", "other"], "left").groupBy(
        "host", "class").agg(F.max(F.struct(F.coalesce("depth", F.lit(0)).alias("depth"), "other", "mark")).alias("in"))
    return kept.join(parents, ["host", "class"], "left").select(
        "host", "n_pages", "class", "tokens", F.col("in.other").alias("parent"), F.col("in.mark").cast("int").alias("gap"))


def _join_by_host(pages: DataFrame, templates: DataFrame, column: str, how: str) -> DataFrame:
    """Pages beside their host's row, broadcast while all rows together are small."""
    held = stage_table(templates, "hosts")
    size = held.agg(F.sum(F.octet_length(column) + F.octet_length("host") + 64)).first()[0] or 0
    return pages.join(F.broadcast(held) if size <= BROADCAST_BYTES else held, "host", how)


def template_of(tokens: list[str], n_pages: int) -> dict:
    """What reading a page needs of a host's template: labels of tags, paths of signatures, text that is template."""
    tags = [t for t in tokens if "\x01" not in t]
    paths = defaultdict(set)
    for t in tags:
        kind = "<" if "<" in t else "/"
        path, mark = t.rsplit(kind, 1)
        paths[kind + mark].add(path)
    places = {s: [m for m in next(iter(p)).split("/") if m] for s, p in paths.items() if len(p) == 1}
    texts = {t for t in tokens if "\x01" in t} if n_pages >= TEXT_PAGES else set()
    return {"tags": set(tags), "places": places, "texts": texts}


def main_texts(pages: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """``pages(page_id, url, html)`` with their main text: page_id, url, text, n_chars (code points).

    Character references are decoded, white space in a block is one blank, blocks are joined in order by two line
    feeds. A line break is white space. Null or empty html, and a page without main text, give an empty text; a null
    url belongs to the host ''. Pages of any length are read whole. Repeated rows are kept and count each. Text that
    stands equally often on every page of a host, like its tags, is template once the host has ``TEXT_PAGES`` pages. Other
    columns are not read. An empty table gives no rows.
    """
    templates = deduce_templates(pages) if templates is None else templates
    # Text is template only in a class that tags vouch for.
    vouched = F.size(F.filter("tokens", lambda t: ~t.contains("\x01"))) >= MIN_TOKENS
    known = templates.where(vouched).groupBy("host").agg(
        F.max("n_pages").alias("n_pages"), F.flatten(F.collect_list("tokens")).alias("tokens"))
    told = _join_by_host(
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), _host(F.col("url")).alias("host")),
        known.select("host", F.to_json(F.struct("n_pages", "tokens")).alias("template")), "template", "left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for page, listed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if listed is None:
                    texts.append(extract(page))
                    continue
                if listed not in templates:
                    if len(templates) > 1000:
                        templates.clear()
                    spec = json.loads(listed)
                    templates[listed] = template_of(spec["tokens"], spec["n_pages"])
                texts.append(extract(page, templates[listed]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return told.select("page_id", "url", "html", "template").mapInArrow(
        read, f"page_id {kind}, url string, text string, n_chars long")
