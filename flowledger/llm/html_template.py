"""Main text of web pages by deducing the template of each host.

Pages of one host come out of a template. A token is an opening tag with its path (tag names and the
classes, ids and roles on the way down). Its occurrence vector says how often it occurs in each page of
the host; tokens with equal vectors form an equivalence class.

* Vectors are never put together: each is summed up, per host and token, as a 64-bit number (a hash of
  the page times the count), so a host with a third of all pages is pre-aggregated in every task.
* Only tokens that occur in at least `SUPPORT` of a host's pages count. A vector that is k times the vector
  of its pages says that the token occurs k times in each: every occurrence is a role of its own, and roles
  on the same pages make up a class. Classes of `SIZE` roles, or on every page, are valid as far as they nest:
  every token lies below another of the template. Together they are the frame.
* The frame divides a page into slots; each block belongs to the slot of the nearest role above it.
* Text that is the same wherever its slot occurs, and blocks that return in most of the host's different
  contents, belong to the template, also inside an article.
* Tags, roles and the words of class and id only pick among slots: menus, headers, footers, sidebars, notices,
  adverts, forms, scripts, styles and reader comments are dropped with all below them; a page that marks its
  article (article, main, or the role or property of either) keeps what it marks, also below a class word. A
  class word other than one for comments is overruled where it marks most of the differing text.
* Inside a marked article a class or id word only proposes: its element is dropped if the host shows it again
  in other contents. Headings and list items propose nothing, nor does an id that spells the heading it opens
  with (a chapter "Related work"). Hosts with few contents drop what a class, or an id for comments, proposes.
* A form that holds the article, or most text of a page without a marked one, is only a container.
  Other pages take all slots whose text differs; hosts with few contents also take what is the same in the
  lowest common container of those.

Text is decoded, white space inside a block becomes one space, and blocks are joined in page order.

Edge cases: null or empty html and pages without an article text give an empty text; a null or odd url is
a host of its own name; repeated rows are one content; broken markup is
read as far as it goes (unclosed tags end with their parent); very long pages are read whole; columns
called like a result column are replaced, all others pass.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Collection, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowledger.llm.common import unwrapped, wrapped
from flowledger.operators.numbering import stage

SUPPORT = 0.5  # share of a host's pages a template token occurs in, and of its contents a template block
SIZE = 3  # roles in a class that is not on every page, at least
REPEATED_PAGES = 4  # a block must return in that many contents at least to belong to the template
RECURS = 0.01  # share of a host's contents, but two at least, that show an element beside the article again

DEPTH = 512  # paths end there; elements nested deeper than browsers do have the path of the last

RESULT = ["text", "n_chars"]

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg select".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
_CLOSES = {  # an opening tag ends the open one it cannot lie in
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_PARAGRAPH = frozenset(["p"])
_SCOPE = frozenset("article aside body dl div form html main nav ol section table td ul".split())
_NO_P = _BLOCKS - frozenset("body head html li dd dt tr td th tbody thead tfoot caption option".split())
_CONTAINERS = frozenset("article body center div main section td".split())
_ASIDE_TAGS = frozenset(
    "aside button dialog footer head iframe input label menu nav noscript object script select "
    "style svg template textarea title".split()
)
_ASIDE_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search".split()
)
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disclaimer discussion disqus dropdown footer gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo "
    "promoted related replies reply search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
_TALK_WORDS = frozenset("comment comments discussion disqus replies reply".split())  # may outweigh the article
_ARTICLE_TAGS = frozenset(["article", "main"])
_ITEMS = frozenset("h1 h2 h3 h4 h5 h6 li dt dd tr td th".split())  # their words propose nothing in an article

# A comment, a declaration, a tag, or (last group) the start of a tag without an end. Quotes count only behind
# an equals sign, and only if they are closed.
_OTHER = r"!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)"
_NAME = r"(/?)([a-zA-Z][^\s/>]*)"
_QUOTED = r"=\s*(?:\"[^\"]*\"|'[^']*')?+"
_TOKEN = re.compile(rf"<(?:{_OTHER}|{_NAME}([^=>]*+(?:{_QUOTED}[^=>]*+)*+)>|(/?[a-zA-Z]))", re.S)
_LOOSE = re.compile(rf"<(?:{_OTHER}|{_NAME}([^>]*+)>|(/?[a-zA-Z]))", re.S)  # the same where no quote counts
_DECLARED = re.compile("<[!?]")
_NEXT_BLOCK = re.compile(f"</?(?:{'|'.join(sorted(_BLOCKS - {'option'}))})(?=[\\s/>])", re.I)
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
# Flags of a path: an article; beside it by tag or role; beside it by a word of a class or id, and by one for
# reader comments; an article mark on or below an element with such a word, which does not overrule it; in a form.
_ARTICLE, _ASIDE, _WORDED, _TALK, _LIFTED, _FORM = 1, 2, 4, 8, 16, 32


class _Proposal:
    """An element of a page that class or id words propose to drop from inside a marked article: how the host's
    other contents would write it, its id if only that has such a word, and whether the words name comments
    or are of a class."""

    __slots__ = ("key", "name", "sure")

    def __init__(self, key: str, name: str, sure: bool):
        self.key, self.name, self.sure = key, name, sure


class _Element:
    """An open element: its path and which of that path on the page it is, whether the path leads into an
    article or beside it, the paths of the elements on it whose words say beside, those whose words propose
    so below the article mark, and the element above."""

    __slots__ = ("tag", "path", "number", "flags", "words", "inner", "above", "holder")

    def __init__(
        self,
        tag: str,
        path: str,
        number: int,
        flags: int,
        words: tuple[str, ...],
        inner: tuple[_Proposal, ...],
        above: _Element | None,
    ):
        self.tag, self.path, self.number, self.flags = tag, path, number, flags
        self.words, self.inner, self.above = words, inner, above
        # inline elements do not tell blocks apart
        self.holder: _Element = self if above is None or tag in _BLOCKS else above.holder


def _marks(tag: str, rest: str) -> tuple[str, int, bool, str, bool]:
    """How an opening tag is written in a path, its own flags, whether `header` is its only word, its id, and
    whether a class, or nothing but words for comments, says beside."""
    label, flags, name_ = tag, 0, ""
    words: set[str] = set()
    by_class = False
    roles: set[str] = set()
    if "=" in rest:
        for name, value in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id", "role", "itemprop"):
                label += f"[{name}={' '.join(sorted(value.split()))}]"
            if name in ("class", "id"):
                words.update(own := _WORD.findall(value))
                by_class |= name == "class" and not _ASIDE_WORDS.isdisjoint(own)
            if name == "id":
                name_ = value
            elif name in ("role", "itemprop"):
                roles.update(value.split())
    if tag in _ARTICLE_TAGS or roles & {"main", "article", "articlebody"}:
        flags = _ARTICLE
    if tag in _ASIDE_TAGS or roles & _ASIDE_ROLES:
        flags = _ASIDE
    elif tag == "form":
        flags |= _FORM
    sure = by_class or bool(words) and words <= _TALK_WORDS
    words = words & _ASIDE_WORDS if tag not in ("body", "html") else set()
    if words & _TALK_WORDS:
        flags |= _TALK
    elif words:
        flags |= _WORDED
    return label, flags, words == {"header"}, name_, sure


def _entered(above: int, own: int, header: bool) -> int:
    """Flags inside an element with the flags `own` that lies below `above`."""
    if above & _ARTICLE and header:
        own &= ~_WORDED  # the header of an article is not that of the page
    flags = above | own
    if own & _ARTICLE:
        flags = flags & ~_FORM | own & _FORM
        if flags & (_WORDED | _TALK):
            flags = flags & ~_WORDED | _LIFTED
    return flags


def blocks(page: str) -> tuple[Counter, list[tuple[_Element, str]]]:
    """Tokens of a page with their counts, and its text blocks with the elements they lie in."""
    tokens: Counter = Counter()
    found: list[tuple[_Element, str]] = []
    root = _Element("", "", 1, 0, (), (), None)
    pattern, endless = _TOKEN, set()  # tags that have no end tag in the rest of the page
    open_, text, at = [root], [], 0
    opened: Counter = Counter()  # open elements by tag
    known: dict[tuple[str, str], tuple[str, int, bool, str, bool]] = {}

    def end_block():
        if text:
            block = "".join(text)
            block = " ".join((entities.unescape(block) if "&" in block else block).split())
            text.clear()
            if block:
                found.append((open_[-1].holder, block))

    def close(tags: Collection[str], stop: Collection[str]):
        for tag in tags:
            if opened[tag]:
                break
        else:
            return
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in tags:
                for e in open_[i:]:
                    opened[e.tag] -= 1
                del open_[i:]
                return
            if open_[i].tag in stop:
                return

    size = len(page)
    while at < size:
        token = pattern.search(page, at)
        if token is None:
            text.append(page[at:])
            break
        if token[4] is not None:  # a tag without an end
            if pattern is _TOKEN:  # one that its quotes hide: from here on, none counts
                pattern = _LOOSE
                continue
            rest = _DECLARED.search(page, at)  # no tag can follow
            text.append(page[at : rest.start() if rest else size])
            break
        if token.start() > at:
            text.append(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            if tag in _BLOCKS:
                end_block()
            if opened[tag]:
                close((tag,), ())
            continue
        if tag in _BLOCKS:
            end_block()
            if tag in _NO_P:
                close(_PARAGRAPH, _SCOPE)
            if tag in _CLOSES:
                close(_CLOSES[tag], _SCOPE - _CLOSES[tag])
        if (marks := known.get((tag, token[3]))) is None:
            marks = known[tag, token[3]] = _marks(tag, token[3])
        label, own, header, name, sure = marks
        above = open_[-1]
        inside = above.flags & _ARTICLE
        if inside and tag in _ITEMS:
            own &= ~(_WORDED | _TALK)
        path, flags = f"{above.path}>{label}", _entered(above.flags, own, header)
        words, inner = above.words, above.inner
        if own & _ARTICLE:
            words = inner = ()
        elif own & (_WORDED | _TALK) and not (header and inside):
            if own & _WORDED:
                words += (path,)
            if inside:
                inner += (_Proposal(_DIGITS.sub("0", label), "" if sure else name, sure),)
        if tag == "header" and not inside:
            flags |= _ASIDE  # a page's own header, not that of an article
        tokens[path] += 1
        if tag == "br":
            text.append(" ")
        if tag in _VOID or token[3].endswith("/"):
            continue
        if tag in _RAW:  # what it holds is no markup
            end = None if tag in endless else re.compile(f"</{tag}\\b", re.I).search(page, at)
            closed = page.find(">", end.end()) + 1 if end else 0
            if not closed:
                endless.add(tag)
                if tag in ("svg", "select"):  # never closed: ends where page text goes on
                    end = _NEXT_BLOCK.search(page, at)
                    at = end.start() if end else size
                    continue
            at = closed or size
            continue
        opened[tag] += 1
        if len(open_) < DEPTH:
            open_.append(_Element(tag, path, tokens[path], flags, words, inner, above))
        else:  # a path that grew no further; end tags and marks count at any depth
            open_.append(_Element(tag, above.path, above.number, flags, words, inner, above))
    end_block()
    return tokens, found


def _is_container(path: str) -> bool:
    return path.rpartition(">")[2].partition("[")[0] in _CONTAINERS


# --- the template of a host ---------------------------------------------------------------------------


def _page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: its tokens with counts."""
    for batch in batches:
        out: list[list] = [[] for _ in range(4)]
        for host, number, page in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html")), strict=True):
            for path, n in blocks(page or "")[0].items():
                for column, value in zip(out, (host, number, path, n), strict=True):
                    column.append(value)
        types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["host", "page", "token", "n"]
        )


def host_of(url: str = "url"):
    """The host of a url in lower case; other texts are their own host, null is empty."""
    host = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.coalesce(F.when(host != "", host), F.col(url), F.lit("")))


def deduce_templates(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per host and valid equivalence class: its tokens, in path order, and its vector.

    `pages` has host, page (a number) and html. At most 1 / support times as many tokens are kept per host
    as a page holds on average.
    """
    tokens = pages.mapInArrow(_page_tokens, "host string, page bigint, token string, n bigint")
    # the occurrence vector as one number, and that of the pages alone
    here = F.xxhash64("page").cast("decimal(20,0)")
    part = here * F.col("n").cast("decimal(10,0)")
    summed = stage(
        tokens.groupBy("host", "token").agg(
            F.count("*").alias("pages"),
            F.sum("n").alias("total"),
            F.sum(part.cast("decimal(38,0)")).cast("string").alias("vector"),
            F.sum(here.cast("decimal(38,0)")).cast("string").alias("set"),
        )
    )
    sizes = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    frequent = summed.join(sizes, "host").where(F.col("pages") >= F.lit(support) * F.col("host_pages"))
    return frequent.groupBy("host", "host_pages", "pages", "total", "vector", "set").agg(
        F.sort_array(F.collect_list(F.struct("token"))).alias("tokens")
    )


def frame_of(classes: list[dict]) -> set[str]:
    """The tokens of one host whose occurrences have fixed roles, from its classes of equal vectors.

    A vector that is a whole multiple of that of its pages says: so many times in each of them. Each of
    the occurrences then has a role of its own, and the roles on the same pages are one class. Classes are
    valid if they are large or on every page, and their tokens as far as they nest.
    """
    roles: dict[tuple, list[tuple[str, int]]] = {}
    for c in classes:
        times = c["total"] // c["pages"]
        if times * int(c["set"]) == int(c["vector"]):
            everywhere = c["pages"] == c["host_pages"]
            roles.setdefault((everywhere, c["set"]), []).extend((t["token"], times) for t in c["tokens"])
    valid = {
        token for (everywhere, _), own in roles.items() if everywhere or sum(n for _, n in own) >= SIZE for token, _ in own
    }
    frame = {""}
    for token in sorted(valid, key=lambda t: t.count(">")):
        if token.rpartition(">")[0] in frame:
            frame.add(token)
    return frame


def _frame_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(r["host"], sorted(map(_number, frame_of(r["classes"])))) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
            ["host", "frame"],
        )


# --- slots --------------------------------------------------------------------------------------------


def _number(text: str) -> int:
    """A 64-bit hash of a text, the same in every process."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def slots_of(found: list[tuple[_Element, str]], frame: set[int]) -> list[str]:
    """The slot of each block: the nearest token of the frame above it and which occurrence that is.

    An element between the two whose words say beside is a slot of its own.
    """
    numbers: dict[str, int] = {}
    known: dict[int, str] = {}
    out = []
    for holder, _ in found:
        if (slot := known.get(id(holder))) is None:
            e = holder
            while e.above is not None:
                if (number := numbers.get(e.path)) is None:
                    number = numbers[e.path] = _number(e.path)
                if number in frame:
                    break
                e = e.above
            slot = f"{e.path}#{e.number}"
            if holder.words and len(holder.words[-1]) > len(e.path):
                slot = f"{holder.words[-1]}#0"
            known[id(holder)] = slot
        out.append(slot)
    return out


def _slug(text: str) -> str:
    return "".join(c for c in text.lower() if c.isalnum())


def proposals(found: list[tuple[_Element, str]]) -> dict[_Proposal, list[str]]:
    """The blocks of each element that its words propose to drop, but for those that open with their own name."""
    texts: dict[_Proposal, list[str]] = {}
    for e, block in found:
        if not e.flags & _ASIDE:
            for p in e.inner:
                texts.setdefault(p, []).append(block)
    return {p: t for p, t in texts.items() if not p.name or _slug(t[0]) != _slug(p.name)}


def article_blocks(
    found: list[tuple[_Element, str]], beside: set[int] = frozenset()
) -> tuple[list[tuple[_Element, str]], bool]:
    """The blocks the article is picked from, and whether the page itself says where it is.

    `beside` has the numbers of the proposed elements that the host drops.
    """
    gone = {p for p in proposals(found) if _number(p.key) in beside} if beside else set()
    free = [(e, block) for e, block in found if not e.flags & _ASIDE and gone.isdisjoint(e.inner)]
    kept = [p for p in free if not p[0].flags & _FORM]

    def is_plain(e: _Element) -> bool:
        return bool(e.flags & _ARTICLE) and not e.flags & _LIFTED and (bool(e.inner) or not e.flags & (_WORDED | _TALK))

    def is_lifted(e: _Element) -> bool:
        return bool(e.flags & _LIFTED) and (bool(e.inner) or not e.flags & (_WORDED | _TALK))

    plain = [p for p in kept if is_plain(p[0])]
    if sum(len(block) for e, block in kept if is_lifted(e)) > sum(len(block) for _, block in plain):
        return [p for p in kept if is_plain(p[0]) or is_lifted(p[0])], True
    if plain:
        return plain, True
    if sum(len(block) for _, block in free) > 2 * sum(len(block) for _, block in kept):
        kept = free  # the page lies in a form
    talk = [p for p in kept if p[0].flags & _LIFTED and not p[0].flags & _WORDED]
    other = [p for p in kept if not p[0].flags & (_TALK | _LIFTED)]
    return (talk, True) if talk and not any(not e.flags & _WORDED for e, _ in other) else (other, False)


def _page_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: a hash of all blocks, those of the different blocks, its slots with a hash of their text, and
    the elements that propose to be dropped."""
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        names = ("host", "html", "frame")
        for host, page, frame in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            every = blocks(page or "")[1]
            found, marked = article_blocks(every)
            proposed: dict[int, bool] = {}
            for p in proposals(every):
                key = _number(p.key)
                proposed[key] = proposed.get(key, False) or p.sure
            texts: dict[tuple[str, str], list[str]] = {}
            for slot, (e, block) in zip(slots_of(found, set(frame or [])), found, strict=True):
                texts.setdefault((slot, e.words[-1] if e.words else ""), []).append(block)
            slots = [
                {"slot": k, "words": w, "marked": marked, "text": _number("\n".join(v)), "chars": sum(map(len, v))}
                for (k, w), v in sorted(texts.items())
            ]
            whole = _number("\n".join(block for _, block in found))
            beside = [{"key": k, "sure": v} for k, v in sorted(proposed.items())]
            row = (host, whole, [_number(b) for b in dict.fromkeys(b for _, b in found)], slots, beside)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, _SLOT_TYPES, strict=True)],
            ["host", "content", "blocks", "slots", "beside"],
        )


_SLOT_TYPES = [
    pa.string(),
    pa.int64(),
    pa.list_(pa.int64()),
    pa.list_(
        pa.struct(
            [("slot", pa.string()), ("words", pa.string()), ("marked", pa.bool_()), ("text", pa.int64()), ("chars", pa.int64())]
        )
    ),
    pa.list_(pa.struct([("key", pa.int64()), ("sure", pa.bool_())])),
]
_SLOTS = (
    "host string, content bigint, blocks array<bigint>, "
    "slots array<struct<slot:string,words:string,marked:boolean,text:bigint,chars:bigint>>, "
    "beside array<struct<key:bigint,sure:boolean>>"
)


def _path(slot: str) -> str:
    return slot.rpartition("#")[0]


def _below(path: str, container: str) -> bool:
    return container == "" or path == container or path.startswith(container + ">")


def article_container(slots: list[dict]) -> str:
    """The lowest common container of all differing slots, of a host whose pages mark no article."""
    paths = [_path(s["slot"]).split(">") for s in slots]
    common = []
    for level in zip(*paths):
        if len(set(level)) > 1:
            break
        common.append(level[0])
    while common and not _is_container(">".join(common)):
        common.pop()
    return ">".join(common)


def lifted_words(slots: list[dict]) -> str:
    """The path of the element that holds more differing text than all slots without a word, if a word marks it."""
    chars: Counter = Counter()
    for s in slots:
        chars[s["words"]] += s["chars"]
    other = chars.pop("", 0)
    path = max(chars, key=lambda p: (chars[p], p), default="")
    return path if chars[path] > other else ""


def decide(contents: int, slots: list[dict]) -> tuple[str, str, list[str]]:
    """(lifted, fixed): the element down to which class words do not count since the main slot is in it, and
    the slots that hold template text.

    `slots` are those in at least `SUPPORT` of the host's different contents. A slot is fixed if its text
    is the same everywhere; with few contents only outside the container, where chance counts less.
    """
    fixed = [s for s in slots if contents > 1 and s["least"] == s["most"] and s["contents"] > SUPPORT * contents]
    names = {s["slot"] for s in fixed}
    differing = [s for s in slots if not s["marked"] and s["slot"] not in names]
    lifted = lifted_words(differing)
    container = article_container([s for s in differing if _below(lifted, s["words"])])
    return lifted, sorted(
        s["slot"]
        for s in fixed
        if s["contents"] >= REPEATED_PAGES or not s["marked"] and not _below(_path(s["slot"]), container)
    )


def _decided_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(r["host"], *decide(r["host_contents"], r["slots"])) for r in batch.to_pylist()]
        columns = [[r[i] for r in rows] for i in range(3)]
        types = [pa.string(), pa.string(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["host", "lifted", "fixed"]
        )


def templates(pages: DataFrame) -> DataFrame:
    """Per host: its frame, the class words to overrule, its slots of template text, blocks most contents share,
    and the elements beside the article inside of it.

    Copies of one content count once, else the article that most pages copy would be taken for template.
    """
    classes = deduce_templates(pages)
    whole = F.struct("host_pages", "pages", "total", "vector", "set", "tokens")
    frames = stage(
        classes.groupBy("host")
        .agg(F.collect_list(whole).alias("classes"))  # at most the frequent tokens of one host
        .mapInArrow(_frame_rows, "host string, frame array<bigint>")
    )
    found = pages.join(frames, "host", "left").mapInArrow(_page_slots, _SLOTS)
    first = F.min(F.struct("blocks", "slots", "beside")).alias("first")
    contents = stage(found.groupBy("host", "content").agg(first).select("host", "first.*"))
    sizes = contents.groupBy("host").agg(F.count("*").alias("host_contents"))
    shared = (
        contents.select("host", F.explode("blocks").alias("block"))
        .groupBy("host", "block")
        .agg(F.count("*").alias("contents"))
        .where(F.col("contents") >= REPEATED_PAGES)
        .join(sizes, "host")
        .where(F.col("contents") > F.col("host_contents") * F.lit(SUPPORT))
        .groupBy("host")
        .agg(F.collect_list("block").alias("repeated"))  # at most twice the blocks of an average page
    )
    decided = (
        contents.select("host", F.inline("slots"))
        .groupBy("host", "slot", "words", "marked")
        .agg(
            F.count("*").alias("contents"),
            F.min("text").alias("least"),
            F.max("text").alias("most"),
            F.sum("chars").alias("chars"),
        )
        .join(sizes, "host")
        .where(F.col("contents") >= F.col("host_contents") * F.lit(SUPPORT))
        .groupBy("host", "host_contents")
        .agg(F.collect_list(F.struct("slot", "words", "marked", "contents", "least", "most", "chars")).alias("slots"))
        .mapInArrow(_decided_rows, "host string, lifted string, fixed array<string>")
    )
    again = F.col("contents") >= F.greatest(F.lit(2), F.col("host_contents") * F.lit(RECURS))
    beside = (
        contents.select("host", F.inline("beside"))
        .groupBy("host", "key")
        .agg(F.count("*").alias("contents"), F.bool_or("sure").alias("sure"))
        .join(sizes, "host")
        .where(again | (F.col("sure") & (F.col("host_contents") < REPEATED_PAGES)))
        .groupBy("host")
        .agg(F.collect_list("key").alias("beside"))  # at most 1 / RECURS times those of an average page
    )
    found = sizes.select("host")  # a host need not have a frame
    for part in (frames, decided, shared, beside):
        found = found.join(part, "host", "left")
    return stage(found)


def main_text(
    page: str | None,
    frame: list[int] | None,
    lifted: str | None,
    fixed: list[str] | None,
    repeated: list[int] | None,
    beside: list[int] | None = None,
) -> str:
    found, marked = article_blocks(blocks(page or "")[1], set(beside or []))
    gone, same = set(repeated or []), set(fixed or [])
    if not marked:
        found = [p for p in found if all(_below(lifted or "", w) for w in p[0].words)]
    if gone or same:
        slots = slots_of(found, set(frame or []))
        found = [p for s, p in zip(slots, found, strict=True) if s not in same and _number(p[1]) not in gone]
    return " ".join(block for _, block in found)


def extract(pages: DataFrame) -> DataFrame:
    """`pages` (with url and html) with `text` and `n_chars` (its code points)."""

    @F.arrow_udf("string")
    def text_of(
        html: pa.Array, frame: pa.Array, lifted: pa.Array, fixed: pa.Array, repeated: pa.Array, beside: pa.Array
    ) -> pa.Array:
        rows = zip(html, frame, lifted, fixed, repeated, beside, strict=True)
        return pa.array([main_text(*(x.as_py() for x in row)) for row in rows], pa.string())

    rows = wrapped(pages, host_of().alias("host"), F.monotonically_increasing_id().alias("page"), "html")
    found = rows.drop("page").join(templates(rows.drop("row")), "host", "left")
    text = found.withColumn("text", text_of("html", "frame", "lifted", "fixed", "repeated", "beside"))
    return unwrapped(text.withColumn("n_chars", F.char_length("text").cast("bigint")), *RESULT)
