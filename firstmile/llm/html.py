"""HTML main text through wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of tags and texts, read as nested groups. Two streams of a host
are aligned level by level by their longest common subsequence, which is exact for
groups of any width: groups that match go on inside, neighbouring groups of one kind
become one repeated group (x)+, a group that only one side has becomes optional (x)?,
texts that differ become a slot, texts that agree stay constant. The result generalises
both, has no alternatives, and is aligned with the next page.

A group's kind is its tag with its class; of a container without class, its tag with
what it holds: text, lists, prose or other containers. So groups that only stand side
by side are not taken for repetitions of one. Where more than `OPTIONAL` optional groups
of a tag have come to stand in one gap, as with a class a page, they become one whose
class is open; that alone bounds a wrapper, by the groups of single pages.

The order of alignment is that of the pages' digests: each page is written as its own
wrapper, without its long texts; pages of a host whose digests begin alike are aligned
in order, then what comes of them. So the same pages give the same wrapper, however they
are dealt over files and tasks, and a host of any size is many tasks' work.

The wrapper says where a host's article is. An `article` or `main` element is markup for
just that. Without one it is the smallest group that holds all text but what the wrapper
shows to be frame: links; blocks of texts that are the same in their place on distinct
pages; where no class tells more, blocks that are one short slot on every page beside one
group of prose. Navigation, header, footer, side, notice, advert, form, script, style and
comment groups go. Pages are told apart by their three longest texts, so that copies with
another date count once, and a long notice does not make all pages copies. A page without
the host's article group is read by its own wrapper.

NULL html or url is allowed: empty html gives an empty text; pages without a host
form no group and are read by their own wrapper. Blocks are joined by one line
break, white space inside a block is one space, character references are decoded,
`br` is white space. Repeated pages give equal rows. Pages are read whole, in time
linear in their length. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstmile.llm import store
from firstmile.llm.columns import slices, values

#: Optional groups of one tag that may stand in one gap before they become one of open class.
OPTIONAL = 16
#: Parts into which a host's pages fall by their digests.
PARTS = 1024
#: Characters up to which a wrapper holds a constant text itself; of longer ones it holds a digest.
SHOWN = 64
#: Bytes of rules up to which every task gets all of them.
SENT = 48 << 20
#: Rows of the bit matrix of an alignment times its columns; wider groups are cut in two first.
BITS = 1 << 28

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
#: Elements whose start ends an open paragraph, and that stand for blocks of text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul option caption".split()
)
#: Elements that a new one of the kind on the left ends, if open within the innermost of the third kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = frozenset("ul ol menu dl table select body html article section div main nav aside footer header".split())
DROPPED = frozenset(
    "nav footer aside form script style noscript template title head button select textarea iframe svg object canvas "
    "dialog menu xmp noembed noframes input audio video annotation annotation-xml search".split()
)
#: Parts of class names, ids and roles that name what is not the article.
NAMED = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice pagination popup promo promotion related "
    "respond share sharing sidebar social sponsor sponsored subscribe toolbar widget complementary contentinfo search form alert".split()
)
COMMENTS = frozenset("comment comments disqus respond".split())
#: First parts that only tell of what stands elsewhere, as in "with-sidebar".
ABOUT = frozenset("has with no without is not".split())
ARTICLE = frozenset(("article", "main"))
#: Elements whose links are text.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | {"p", "pre", "blockquote", "figcaption", "dd"}
#: Blocks that are parts of an article, never all of it.
SMALLEST = PROSE | {"li", "td", "th", "dt"}
#: Elements that hold the article, whatever their class says.
FRAMES = ARTICLE | {"html", "body"}

#: Containers whose tag says nothing; without a class they are told apart by what they hold.
GENERIC = frozenset("div section center".split())
LISTS = frozenset("ul ol dl menu table".split())
#: The class of a group that stands for any class, and for any class that goes.
OPEN, OPEN_GOES = "*", "! *"

_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""")
_ENDS = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}
_LETTER = re.compile(r"\w")
_PARTS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """A tag with its class and children; text nodes have tag '' and their text in name.

    The class of a group that goes starts with "!".
    """

    __slots__ = ("children", "dropped", "name", "tag")

    def __init__(self, tag: str, name: str = "", dropped: bool = False):
        self.tag, self.name, self.dropped, self.children = tag, name, dropped, []


def _attributes(source: str, tag: str, inside: bool) -> tuple[str, bool, bool]:
    """The class as a name, numbers left out; whether the element goes; whether nothing but its id says so.

    In an article, and for parts of a text anywhere, only whole names count. An id made from a heading's text says nothing.
    """
    name, bad, by_id = "", False, False
    whole = inside or tag in SMALLEST
    for m in _ATTRIBUTE.finditer(source):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role"):
            parts = [_PARTS.findall(x) for x in value.split()]
            if key == "id" and (tag in HEADINGS or tag in ("p", "section") and not any(len(p) == 1 and p[0] in COMMENTS for p in parts)):
                continue
            if whole:
                against = any(p and all(x in NAMED for x in (p if key == "class" else [" ".join(p)])) for p in parts)
            else:
                against = any(p and p[0] not in ABOUT and (p[0] in NAMED or p[-1] in NAMED) for p in parts)
            if key == "class":
                name = " ".join(x for p in parts for x in p)
            if key == "id" and not any(p[:1] and p[0] in COMMENTS for p in parts):
                by_id = by_id or against
            else:
                bad = bad or against
        elif key == "style":
            bad = bad or bool(_HIDDEN.search(value))
        elif key == "aria-hidden":
            bad = bad or value == "true"
    bad = bad or bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", _ATTRIBUTE.sub("", source)))
    return name, bad or by_id, by_id and not bad


def tokens(source: str) -> Iterator[tuple[str, str, str]]:
    """(kind, value, attributes): '<' for a start tag, '>' for an end tag, '' for text."""
    at, size, no_quote = 0, len(source), False
    while at < size:
        cut = source.find("<", at)
        if cut < 0:
            yield "", source[at:], ""
            return
        if cut > at:
            yield "", source[at:cut], ""
        if source.startswith("<!--", cut):
            end = source.find("-->", cut + 4)
            at = size if end < 0 else end + 3
        elif source.startswith(("<!", "<?"), cut):
            end = source.find(">", cut)
            at = size if end < 0 else end + 1
        elif m := (None if no_quote else _TAG.match(source, cut)):
            at = m.end()
            tag = m[2].lower()
            yield (">" if m[1] else "<"), tag, m[3]
            if tag in RAW and not m[1]:
                found = _ENDS[tag].search(source, at)
                end = found.start() if found else size
                yield "", source[at:end], ""
                at = end
        elif m := re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)").match(source, cut):
            # A quote without its end: the tag reaches to the next '>'.
            end = source.find(">", cut)
            at = size if end < 0 else end + 1
            yield (">" if m[1] else "<"), m[2].lower(), source[m.end() : at - 1] if end >= 0 else ""
        else:
            yield "", "<", ""
            at = cut + 1


def parse(source: str) -> Node:
    """The page as nested groups of any depth; missing end tags are added where HTML adds them."""
    root = Node("#")
    stack = [root]
    # Places in the stack: by tag, of blocks, and of groups that hold items.
    by_tag: dict[str, list[int]] = {}
    blocks: list[int] = []
    holds: list[int] = []
    guessed: Node | None = None  # the last group that goes for its id alone, in an article

    def cut(at: int) -> None:
        while len(stack) > at:
            tag = stack.pop().tag
            by_tag[tag].pop()
            if tag in BLOCKS:
                blocks.pop()
            if tag in HOLDS:
                holds.pop()

    for kind, value, attributes in tokens(source):
        if not kind:
            stack[-1].children.append(Node("", value))
            continue
        if kind == ">":
            if by_tag.get(value):
                cut(by_tag[value][-1])
            continue
        if value in BLOCKS and blocks and stack[blocks[-1]].tag == "p":
            cut(blocks[-1])
        if value in CLOSES:
            last = max((by_tag[t][-1] for t in CLOSES[value] if by_tag.get(t)), default=0)
            if last > (holds[-1] if holds else 0):
                cut(last)
        if value in HEADINGS and stack[-1] is guessed and not any(c.tag for c in guessed.children):
            # The group begins with a heading, which its id is made from.
            guessed.name, guessed.dropped = guessed.name[2:], False
        inside = bool(by_tag.get("article") or by_tag.get("main"))
        name, bad, by_id = _attributes(attributes, value, inside) if attributes.strip() else ("", False, False)
        dropped = value in DROPPED or bad and value not in FRAMES
        node = Node(value, f"! {name}" if dropped else name, dropped)
        if dropped and by_id and inside and value not in DROPPED:
            guessed = node
        stack[-1].children.append(node)
        if value not in VOID and not attributes.endswith("/"):
            by_tag.setdefault(value, []).append(len(stack))
            if value in BLOCKS:
                blocks.append(len(stack))
            if value in HOLDS:
                holds.append(len(stack))
            stack.append(node)
    _name_by_kind(root)
    return root


def _name_by_kind(root: Node) -> None:
    """Give containers without a class a name for what they hold; no class has a slash."""
    todo = [root]
    while todo:
        node = todo.pop()
        todo += [c for c in node.children if c.tag]
        if node.tag in GENERIC and not node.name:
            blocks = {c.tag for c in node.children if c.tag in BLOCKS}
            node.name = "/text" if not blocks else "/prose" if blocks & PROSE else "/list" if blocks <= LISTS else "/box"


# A wrapper is [tag, name, flags, text, own, linked, low, high, children]: flags hold '+' and '?'; text is a constant, or
# None for a slot; own counts the letters of texts right below, linked those below links; low and high are the least and
# largest signs of the pages that have a constant (three numbers a page), different if distinct pages were compared;
# children are wrappers. Nothing here recurs, so groups may be nested as deep as they are.
TAG, NAME, FLAGS, TEXT, OWN, LINKED, LOW, HIGH, CHILDREN = range(9)
NO_SIGN = (0, 0, 0)


def _key(w: list) -> tuple[str, str]:
    return w[TAG], w[NAME]


def _walk(w: list) -> list[list]:
    """All groups of a wrapper, each after the one that holds it."""
    out = [w]
    for x in out:
        out += x[CHILDREN]
    return out


def _shown(text: str) -> str:
    """A text as wrappers hold it."""
    return text if len(text) <= SHOWN else "\x00" + hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def _plain(page: Node) -> list:
    """A page's groups as a wrapper, nothing folded yet."""
    root = [page.tag, page.name, "", None, 0, 0, NO_SIGN, NO_SIGN, []]
    # A link in a sentence or a heading is text like the rest of it.
    todo = [(page, root, False, False, False)]
    texts: list[list] = []
    content: set[str] = set()
    while todo:
        node, out, linked, prose, gone = todo.pop()
        for child in node.children:
            if child.tag:
                w = [child.tag, child.name, "", None, 0, 0, NO_SIGN, NO_SIGN, []]
                out[CHILDREN].append(w)
                todo.append((child, w, linked or child.tag == "a" and not prose, prose or child.tag in PROSE, gone or child.dropped))
            elif text := " ".join(child.name.split()):
                out[LINKED if linked else OWN] += len(text) if _LETTER.search(text) else 0
                if not gone:
                    content.add(text)
                if node.tag not in DROPPED:
                    texts.append(["", "", "", _shown(text), 0, 0, NO_SIGN, NO_SIGN, []])
                    out[CHILDREN].append(texts[-1])
    longest = heapq.nlargest(3, content, key=lambda x: (len(x), x))
    signs = tuple([zlib.crc32(x.encode("utf-8", "replace")) for x in longest] + [0] * (3 - len(longest)))
    for w in texts:
        w[LOW] = w[HIGH] = signs
    return root


def _distinct(w: list) -> bool:
    """Whether the pages of a constant are other pages, not copies: their longest text differs, or two of three do."""
    differ = [low != high for low, high in zip(w[LOW], w[HIGH], strict=True)]
    return differ[0] or sum(differ) > 1


# While groups are merged, a child is (flags, groups that become one).
Item = tuple[str, list[list]]


def _united(a: str, b: str, more: str = "") -> str:
    return "".join(x for x in "+?" if x in a + b + more)


def _folded(items: list[Item]) -> list[Item]:
    """Runs of one group, or of one group with texts and breaks between, as a repeated group."""
    out: list[Item] = []
    for flags, group in items:
        for back in (1, 2):
            if len(out) >= back and _key(out[-back][1][0]) == _key(group[0]) and (back == 1 or out[-1][1][0][TAG] in ("", "br")):
                before, into = out[-back]
                into.extend(group)
                out[-back] = (_united(before, flags, "+"), into)
                if back == 2:
                    out[-1] = (_united(out[-1][0], "?"), out[-1][1])
                break
        else:
            out.append((flags, group))
    return out


def _rows(left: list, right: list) -> list[int]:
    """Bit rows of the longest common subsequence, by Hyyro: in row i a zero at j says that column j adds one to left[:i]."""
    where: dict = {}
    for j, key in enumerate(right):
        where.setdefault(key, []).append(j)
    masks = {}
    for key, places in where.items():
        bits = bytearray(len(right) // 8 + 1)
        for j in places:
            bits[j >> 3] |= 1 << (j & 7)
        masks[key] = int.from_bytes(bits, "little")
    full = (1 << len(right)) - 1
    row, out = full, [full]
    for key in left:
        hit = row & masks.get(key, 0)
        row = ((row + hit) | (row - hit)) & full
        out.append(row)
    return out


def _lengths(row: int, n: int) -> np.ndarray:
    """Length of the common subsequence with right[:j] for j in 0..n."""
    zeros = 1 - np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n].astype(np.int64)
    return np.concatenate(([0], np.cumsum(zeros)))


def _common(left: list, right: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, exact at any length. The first of equal ways counts."""
    n, m = len(left), len(right)
    start = 0
    while start < n and start < m and left[start] == right[start]:
        start += 1
    out = [(i, i) for i in range(start)]
    left, right = left[start:], right[start:]
    n, m = n - start, m - start
    if not n or not m:
        return out
    if n > 1 and n * m > BITS:
        half = n // 2
        ahead = _lengths(_rows(left[:half], right)[-1], m)
        behind = _lengths(_rows(left[half:][::-1], right[::-1])[-1], m)[::-1]
        cut = int(np.argmax(ahead + behind))
        out += [(start + i, start + j) for i, j in _common(left[:half], right[:cut])]
        return out + [(start + half + i, start + cut + j) for i, j in _common(left[half:], right[cut:])]
    # Rows from the end: row k is for left[n - k:], and its low bits for the end of right.
    rows, i, j = _rows(left[::-1], right[::-1]), 0, 0
    while i < n and j < m:
        if left[i] == right[j]:
            out.append((start + i, start + j))
            i, j = i + 1, j + 1
            continue
        low = (1 << (m - j)) - 1
        if (rows[n - i - 1] & low).bit_count() == (rows[n - i] & low).bit_count():
            i += 1
        else:
            j += 1
    return out


def _open(w: list) -> list:
    """A copy of a group whose class is open."""
    out = w[:]
    out[NAME] = OPEN_GOES if w[NAME].startswith("!") else OPEN
    return out


def _tag_key(item: Item) -> tuple[str, bool]:
    w = item[1][0]
    return w[TAG], w[NAME].startswith("!")


def _gap(left: list[Item], right: list[Item]) -> list[Item]:
    """What stands between two matches, all of it optional.

    A tag that both sides have groups of, and together too many, gets one of open class, which takes in all that come later.
    """
    items = [(_united(flags, "?"), group) for flags, group in (*left, *right)]
    if not left or not right:
        return items
    often = Counter(map(_tag_key, items))
    both = {_tag_key(x) for x in left} & {_tag_key(x) for x in right}
    already = {_tag_key(x) for x in items if x[1][0][NAME] in (OPEN, OPEN_GOES)}
    out: list[Item] = []
    opened: dict[tuple[str, bool], Item] = {}
    for flags, group in items:
        key = _tag_key((flags, group))
        if not key[0] or key not in both or often[key] <= OPTIONAL and key not in already:
            out.append((flags, group))
        elif key in opened:
            opened[key][1].extend(map(_open, group))
        else:
            opened[key] = ("+?", [_open(w) for w in group])
            out.append(opened[key])
    return out


def _aligned(a: list[Item], b: list[Item]) -> list[Item]:
    """Children aligned by their longest common subsequence of groups; what one side lacks is optional."""
    left, right = [_key(g[0]) for _, g in a], [_key(g[0]) for _, g in b]

    def both(x: Item, y: Item) -> Item:
        x[1].extend(y[1])
        return _united(x[0], y[0]), x[1]

    if left == right:
        return [both(x, y) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    for x, y in [*_common(left, right), (len(a), len(b))]:
        out += _gap(a[i:x], b[j:y])
        if x < len(a):
            out.append(both(a[x], b[y]))
        i, j = x + 1, y + 1
    return _folded(out)


def _level(group: list[list]) -> list[Item]:
    """The children of the group that generalises some."""
    now: list[Item] | None = None
    for w in group:
        these = _folded([(c[FLAGS], [c]) for c in w[CHILDREN]])
        now = these if now is None else _aligned(now, these)
    return now or []


def _head(flags: str, group: list[list]) -> list:
    """The group that generalises some of one key, without its children."""
    first = group[0]
    if len(group) == 1:
        return [*_key(first), flags, *first[TEXT:CHILDREN], []]
    own, linked = sum(w[OWN] for w in group), sum(w[LINKED] for w in group)
    text, low, high = first[TEXT], NO_SIGN, NO_SIGN
    if text is not None and all(w[TEXT] == text for w in group):
        low = tuple(min(x) for x in zip(*(w[LOW] for w in group), strict=True))
        high = tuple(max(x) for x in zip(*(w[HIGH] for w in group), strict=True))
    else:
        text = None
    return [*_key(first), flags, text, own, linked, low, high, []]


def _merged(group: list[list], folded: bool) -> list:
    """The wrapper that generalises groups of one key, from the top down; folded ones are taken as they are."""
    root = _head("".join(x for x in "+?" if any(x in w[FLAGS] for w in group)), group)
    todo = [(root, group)]
    while todo:
        out, group = todo.pop()
        if folded and len(group) == 1:
            out[CHILDREN] = group[0][CHILDREN]
            continue
        for flags, cs in _level(group):
            child = _head(flags, cs)
            out[CHILDREN].append(child)
            if any(c[CHILDREN] for c in cs):
                todo.append((child, cs))
    return root


def wrapper(page: Node) -> list:
    """The wrapper of one page: neighbouring groups of one kind folded into one repeated group."""
    return _merged([_plain(page)], False)


def align(a: list, b: list) -> list:
    """The wrapper that generalises two with the same tag."""
    return _merged([a, b], True)


def _size(w: list) -> int:
    return len(_walk(w))


def merged(a: list | None, b: list) -> list:
    return b if a is None else align(a, b)


def as_text(w: list) -> str:
    """The wrapper as a regular expression over tags: #TEXT for a slot."""
    out: list[str] = []
    todo: list[list | str] = [w]
    while todo:
        w = todo.pop()
        if isinstance(w, str):
            out.append(w)
            continue
        flags = w[FLAGS]
        end = f"){flags.replace('+?', '*')}" if flags else ""
        out.append("(" if flags else "")
        if w[TAG]:
            out.append(f"<{w[TAG]}>")
            todo += [f"</{w[TAG]}>{end}", *reversed(w[CHILDREN])]
        else:
            out.append(("#TEXT" if w[TEXT] is None else w[TEXT].replace("\x00", "#")) + end)
    return "".join(out)


def packed(w: list) -> str:
    """The wrapper as JSON: the pages' signs, and a flat list of groups, each with the number of its children."""
    signs: dict[tuple, int] = {NO_SIGN: 0}
    flat: list = []
    for x in _walk(w):
        low, high = (signs.setdefault(tuple(s), len(signs)) for s in (x[LOW], x[HIGH]))
        flat += (*x[:LOW], low, high, len(x[CHILDREN]))
    return json.dumps([list(signs), flat])


def unpacked(text: str) -> list:
    signs, flat = json.loads(text)
    signs = [tuple(s) for s in signs]
    width = CHILDREN + 1
    every = [[*flat[i : i + LOW], signs[flat[i + LOW]], signs[flat[i + HIGH]], flat[i + CHILDREN]] for i in range(0, len(flat), width)]
    at = 1
    for w in every:
        n = w[CHILDREN]
        w[CHILDREN] = every[at : at + n]
        at += n
    return every[0]


def _letters(every: list[list], without: set[int]) -> dict[int, int]:
    """By id of a group: letters in it outside links, and outside what goes anyway."""
    out: dict[int, int] = {}
    for w in reversed(every):
        goes = w[NAME].startswith("!") or w[TAG] == "header" or id(w) in without
        out[id(w)] = 0 if goes else w[OWN] + sum([out[id(c)] for c in w[CHILDREN]])
    return out


def _holds_text(every: list[list]) -> set[int]:
    """Ids of groups with any text that does not go."""
    out: set[int] = set()
    for w in reversed(every):
        if not w[NAME].startswith("!") and (w[OWN] or w[LINKED] or any(id(c) in out for c in w[CHILDREN])):
            out.add(id(w))
    return out


# The way to a group: for each level the tag, the class, and, if that is open, the classes that have groups of their own there.
Step = tuple[str, str, tuple[str, ...]]


def _step(w: list, child: list) -> Step:
    others = {c[NAME] for c in w[CHILDREN] if c[TAG] == child[TAG]} - {OPEN} if child[NAME] == OPEN else ()
    return child[TAG], child[NAME], tuple(sorted(others))


def _fits(node: Node, step: Step) -> bool:
    return node.tag == step[0] and (node.name == step[1] or step[1] == OPEN and node.name not in step[2])


def _fixed(every: list[list]) -> set[int]:
    """Ids of blocks with nothing but texts that agree over distinct pages, and of all in them."""
    # By id of a group: whether it has a text that was compared and agrees, and one that differs or was not compared.
    same: dict[int, tuple[bool, bool]] = {}
    for w in reversed(every):
        agrees = w[TEXT] is not None and _distinct(w)
        found = (False, False) if w[TAG] else (agrees, not agrees)
        for c in w[CHILDREN]:
            found = found[0] or same[id(c)][0], found[1] or same[id(c)][1]
        same[id(w)] = (False, False) if w[NAME].startswith("!") else found
    out: set[int] = set()
    for w in every:
        if id(w) in out or w[TAG] in BLOCKS and same[id(w)] == (True, False):
            out.add(id(w))
            out.update(map(id, w[CHILDREN]))
    return out


def _template(every: list[list], fixed: set[int]) -> list | None:
    """The wrapper with the texts of its fixed blocks, all else as far as their places need it."""
    if not fixed:
        return None
    kept = set(fixed)
    for w in reversed(every):
        if any(id(c) in kept for c in w[CHILDREN]):
            kept.add(id(w))
    copies = [[*w[:TEXT], w[TEXT] if id(w) in fixed else None, 0, 0, NO_SIGN, NO_SIGN, w[CHILDREN] if id(w) in kept else []] for w in every]
    copy_of = {id(w): c for w, c in zip(every, copies, strict=True)}
    for c in copies:
        c[CHILDREN] = [copy_of[id(x)] for x in c[CHILDREN]]
    return copies[0]


@functools.lru_cache(256)
def _template_read(text: str) -> list:
    return unpacked(text)


def _placed(nodes: list[Node], w: list) -> list[tuple[Node, list]]:
    """The page's groups, each with the wrapper's child in whose place it stands, aligned as wrappers are."""
    runs: list[tuple[tuple[str, str], list[Node]]] = []
    for x in nodes:
        key = x.tag, x.name if x.tag else ""
        if runs and runs[-1][0] == key:
            runs[-1][1].append(x)
        else:
            runs.append((key, [x]))
    children = w[CHILDREN]
    pairs = _common([key for key, _ in runs], [_key(c) for c in children])
    out, before = [], (-1, -1)
    for i, j in [*pairs, (len(runs), len(children))]:
        # What matched nothing: further groups of a repeated one beside it, or groups of an open class.
        near = children[max(0, before[1]) : j + 1]
        for key, group in runs[before[0] + 1 : i]:
            place = next((c for c in near if _key(c) == key and "+" in c[FLAGS] or _key(c) == (key[0], OPEN)), None)
            out += [(x, place) for x in group if place]
        if i < len(runs):
            out += [(x, children[j]) for x in runs[i][1]]
        before = i, j
    return out


def _constants(page: Node, template: list) -> set[int]:
    """Ids of the page's texts that equal the template's text in their place."""
    out: set[int] = set()
    todo = [(page, template)]
    while todo:
        node, w = todo.pop()
        for child, place in _placed([c for c in node.children if c.tag or c.name.strip()], w):
            if not child.tag:
                if place[TEXT] is not None and place[TEXT] == _shown(" ".join(child.name.split())):
                    out.add(id(child))
            elif place[CHILDREN]:
                todo.append((child, place))
    return out


def _slot(w: list) -> bool:
    """A container without a class that is one differing text, in every page once."""
    return w[NAME] == "/text" and not w[FLAGS] and len(w[CHILDREN]) == 1 and not w[CHILDREN][0][TAG] and w[CHILDREN][0][TEXT] is None


def _prose(w: list) -> bool:
    """A group that holds a heading or repeated prose, once on every page."""
    return not w[FLAGS] and any(c[TAG] in HEADINGS or c[TAG] in PROSE and "+" in c[FLAGS] for c in w[CHILDREN])


def _down(at: list[list], letters: dict[int, int]) -> list[list]:
    """The groups of one kind, below some of one kind, that hold all their text but frame; none if there are no such groups."""
    if any(x[OWN] for x in at):
        return []
    inner = [c for x in at for c in x[CHILDREN] if letters[id(c)]]
    if len({_key(c) for c in inner}) > 1:
        # Short slots beside one group of prose are frame where no class says what they are.
        rest = [c for c in inner if not _slot(c)]
        if len(rest) != 1 or not _prose(rest[0]) or rest[0][NAME] != "/prose" or any(2 * c[OWN] > letters[id(rest[0])] for c in inner if _slot(c)):
            return []
        inner = rest
    return [] if not inner or inner[0][TAG] not in BLOCKS or inner[0][TAG] in SMALLEST else inner


def rules(w: list) -> dict:
    """What the wrapper says about its pages: ways to the article, and the template's own texts in their places."""
    every = _walk(w)
    text, template = _holds_text(every), None
    main: set[tuple[Step, ...]] = set()
    todo: list[tuple[list, tuple[Step, ...]]] = [(w, ())]
    for x, way in todo:
        for c in x[CHILDREN]:
            if c[TAG] in ARTICLE and id(c) in text:
                main.add((*way, _step(x, c)))
            elif c[TAG] and not c[NAME].startswith("!"):
                todo.append((c, (*way, _step(x, c))))
    if not main:
        fixed = _fixed(every)
        letters, template = _letters(every, fixed), _template(every, fixed)
        # Down as long as one group below holds all letters, so that nothing but links, constants and frame is left out.
        at, way = [w], ()
        while inner := _down(at, letters):
            holder = next(x for x in at if any(c is inner[0] for c in x[CHILDREN]))
            way, at = (*way, _step(holder, inner[0])), inner
        main = {way}
    return {"main": sorted(main), "fixed": template and packed(template)}


def _blocks(node: Node, constants: set[int], inside: bool) -> list[list[str]]:
    out: list[list[str]] = [[]]
    todo: list[Node | None] = [*reversed(node.children)]
    while todo:
        child = todo.pop()
        if child is None:
            out.append([])
        elif not child.tag:
            if id(child) not in constants:
                out[-1].append(child.name)
        elif child.tag in ("br", "hr"):
            out[-1].append(" ")
        elif not child.dropped and (child.tag != "header" or inside):
            if child.tag in BLOCKS:
                out.append([])
                todo.append(None)
            todo += reversed(child.children)
    return out


def _groups(page: Node, ways: list[list[Step]]) -> Iterator[Node]:
    """The page's groups at the end of some ways, in the order of the page."""
    todo = [(page, [(way, 0) for way in ways])]
    while todo:
        node, open_ = todo.pop()
        if any(depth == len(way) for way, depth in open_):
            yield node
            continue
        below = []
        for c in node.children:
            if c.tag and not c.dropped:
                there = [(way, depth + 1) for way, depth in open_ if _fits(c, way[depth])]
                if there:
                    below.append((c, there))
        todo += reversed(below)


def text_of(page: Node, found: dict) -> str:
    constants = _constants(page, _template_read(found["fixed"])) if found["fixed"] else set()
    lines = []
    for node in _groups(page, found["main"]):
        lines += [" ".join(entities.unescape("".join(b)).split()) for b in _blocks(node, constants, inside=node.tag in ARTICLE)]
    return "\n".join(x for x in lines if x)


def main_text(source: str | None, found: dict | None) -> str:
    """The article of a page by its host's rules, or by the page's own where those find nothing."""
    if not source:
        return ""
    page = parse(source)
    text = text_of(page, found) if found else ""
    return text or text_of(page, rules(wrapper(page)))


def host(url: str | None) -> str | None:
    try:
        return urlsplit(url or "").hostname or None
    except ValueError:
        return None


def wrappers(pages: DataFrame) -> DataFrame:
    """_host, rules (JSON), pattern (the wrapper as an expression), of every host.

    What moves is a row a page with its groups and short texts, by host and the first bits
    of the page's digest; then a row a part of a host.
    """
    schema = "_host string, part int, digest binary, wrapper string"

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            found = []
            for url, source in zip(values(batch, "url"), values(batch, "html"), strict=True):
                if source and (name := host(url)):
                    digest = hashlib.blake2b(source.encode("utf-8", "replace"), digest_size=16).digest()
                    found.append((name, int.from_bytes(digest[:2]) % PARTS, digest, packed(wrapper(parse(source)))))
            if found:
                kinds = (pa.string(), pa.int32(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], ["_host", "part", "digest", "wrapper"])

    def join(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        """Wrappers of one host, or of one part of it, folded in the order of rows; a page that comes again is passed over."""
        now, held, seen, out = None, None, None, []

        def done() -> list[tuple]:
            if now is None:
                return []
            # A part of one page is that page's row.
            own = held if isinstance(held, list) else unpacked(held)
            return [(now[0], json.dumps(rules(own)), as_text(own))] if last else [(*now, seen, held if isinstance(held, str) else packed(held))]

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(),) * 3 if last else (pa.string(), pa.int32(), pa.binary(), pa.string())
            names = ["_host", "rules", "pattern"] if last else ["_host", "part", "digest", "wrapper"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

        for batch in slices(batches, 100):
            for name, part, digest, w in zip(*(values(batch, c) for c in ("_host", "part", "digest", "wrapper")), strict=True):
                key = (name,) if last else (name, part)
                if key != now:
                    out += done()
                    now, held, seen = key, w, digest
                elif digest != seen:
                    held = align(held if isinstance(held, list) else unpacked(held), unpacked(w))
                    seen = digest
            if len(out) > 200:
                yield batch_of(out)
                out = []
        out += done()
        if out:
            yield batch_of(out)

    each = pages.select("url", "html").mapInArrow(parsed, schema)
    some = each.repartition("_host", "part").sortWithinPartitions("_host", "part", "digest").mapInArrow(lambda b: join(b, False), schema)
    whole = some.repartition("_host").sortWithinPartitions("_host", "part")
    return whole.mapInArrow(lambda b: join(b, True), "_host string, rules string, pattern string")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in slices(batches, 500):
            out = []
            for source, found in zip(values(batch, "html"), values(batch, "rules"), strict=True):
                if found is not None and found not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[found] = json.loads(found)
                out.append(main_text(source, known[found] if found is not None else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    hosts = store.land(wrappers(pages).select("_host", "rules"), "rules")
    size = hosts.agg(F.sum(F.octet_length("rules") + F.octet_length("_host"))).first()[0] or 0
    named = pages.select("page_id", "url", "html", _host().alias("_page_host"))
    # Pages move only where the rules of all hosts are too many for one task.
    joined = named.join(F.broadcast(hosts) if size <= SENT else hosts, F.col("_page_host") == F.col("_host"), "left")
    return joined.select("page_id", "url", "html", "rules").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def _host():
    """The host as urlsplit finds it, for urls of the usual form; others join to nothing and are read on their own."""
    found = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)", 1))
    return F.when(found != "", found)
