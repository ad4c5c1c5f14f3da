"""Main text of web pages by wrapper induction.

Different pages of one host come together in chunks of even size. Every page becomes a tree of all its blocks, menus and adverts
included, in which neighbours of one kind are folded into a list; the trees of a chunk are aligned with the largest of them
by simple tree matching. Blocks of a slot of the aligned tree that stay the same from page to page belong to the template.
The slots that vary say where the content lies: in the innermost element that holds nearly all of the text outside of
links, on the average of the pages. What lies beside that element goes, but for headings and paragraphs on the way to it.
Within it a page's own marks tell what no alignment can, such as a reader's comment from a paragraph; they also decide
where a host has too few different pages. Where a page marks its article, only blocks in it can be content.
"""

from __future__ import annotations

from collections import Counter
from hashlib import blake2b
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Different pages aligned with one another, from half to all of that if the host has so many.
CHUNK = 64
# A host with more than one in SHARE of all pages is split over several tasks; there are fewer such hosts than SHARE.
# No split is made for fewer rows than SPLIT_ROWS.
SHARE = 500
SPLIT_ROWS = 2 * CHUNK
# Rows that wait for their chunk, copies included, and rows of one Arrow batch.
HELD_ROWS = 1 << 16
BATCH_ROWS = 256
# A block is template if so many different pages have its slot, and this share of them the same block in it.
LEAST_PAGES = 4
CONSTANT = 0.8
# An element holds the content if it has this share of the varying text outside of links, on the average of the pages.
DOMINANT = 0.8
# Cells of an alignment that are held at once.
CELLS = 1 << 23

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CODE = frozenset("script style template noscript svg math iframe object canvas select textarea button audio video".split())
NO_CONTENT = CODE | frozenset("head title nav header footer aside form menu dialog".split())
# Marked by what they are, not by a word that a wrapper may have too.
FIRM = NO_CONTENT - frozenset(["header", "form"])
HEADS = frozenset(["head", "title"])
HEAD = frozenset("title base basefont bgsound link meta style script noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ARTICLE = frozenset(["article", "main"])
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
        "section table ul".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
LISTS = frozenset("ul ol dl table select article section div body main".split())
MARKS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies disclaimer "
    "footer header menu nav navbar navigation newsletter notice notices popup promo promotion related share sharing "
    "sidebar social sponsor sponsored subscribe".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())


class Node:
    """An element: its kind, and its texts and elements in order."""

    __slots__ = ("tag", "kind", "marked", "items")

    def __init__(self, tag: str, kind: str, marked: bool):
        self.tag, self.kind, self.marked, self.items = tag, kind, marked, []


class TreeBuilder(HTMLParser):
    """The tree of a page, however badly it is nested. Scripts, styles and comments leave nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", False)
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        names = f"{given.get('class') or ''} {given.get('id') or ''}".lower().split()
        parts = {part for name in names for part in name.replace("_", "-").split("-")}
        marked = tag in NO_CONTENT or not MARKS.isdisjoint(parts) or (given.get("role") or "").lower() in ROLES
        marked = marked or "hidden" in given or (given.get("aria-hidden") or "") == "true"
        self._end_head(tag)
        # Elements that the start of another one ends, unless a list or section lies between.
        for k in range(len(self.open) - 1, 0, -1):
            opened = self.open[k].tag
            if tag in CLOSED_BY.get(opened, ()):
                del self.open[k:]
                break
            if opened in LISTS:
                break
        node = Node(tag, ".".join([tag, *names]), marked)
        self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)

    def _end_head(self, tag: str) -> None:
        """The head ends where something begins that it cannot hold."""
        tags = [node.tag for node in self.open[:4]]
        if "head" in tags and tag not in HEAD and (tag == "body" or self.open[-1].tag == "head"):
            del self.open[tags.index("head") :]

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if data.strip():
            self._end_head("")
        if data and self.open[-1].tag not in CODE:
            self.open[-1].items.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    _settle(builder.root)
    return builder.root


def _settle(top: Node) -> None:
    """Take the marks off elements that cannot be left out, whatever their names say.

    These are html and body, what holds the main element or the largest article, unless that is small next to what is not
    marked, and on pages where no article is free what holds more than half of the page's text. Menus, footers and
    the like stay marked, and so does what holds code.
    """
    nodes, parents = [top], [-1]
    for k, node in enumerate(nodes):
        below = [item for item in node.items if isinstance(item, Node) and item.tag not in CODE]
        nodes += below
        parents += [k] * len(below)
    for node in nodes:
        if node.tag in ("html", "body"):
            node.marked = False
    if not any(node.marked and node.tag not in FIRM for node in nodes):
        return
    own = [sum(len("".join(item.split())) for item in node.items if isinstance(item, str)) for node in nodes]
    size = own[:]
    for k in range(len(nodes) - 1, 0, -1):
        if nodes[k].tag not in FIRM:
            size[parents[k]] += size[k]

    def covered() -> list[bool]:
        out = [False] * len(nodes)
        for k in range(1, len(nodes)):
            out[k] = out[parents[k]] or (nodes[parents[k]].marked and nodes[parents[k]].tag not in ARTICLE)
        return out

    def release(k: int) -> None:
        k = parents[k]
        while k > 0:
            nodes[k].marked = nodes[k].marked and nodes[k].tag in FIRM
            k = parents[k]

    hidden = covered()
    free = sum(n for n, node, away in zip(own, nodes, hidden) if not (away or node.marked))
    articles = [k for k, node in enumerate(nodes) if node.tag in ARTICLE]
    if articles:
        largest = max(articles, key=lambda k: size[k])
        for k in articles:
            if nodes[k].tag == "main" or k == largest and 2 * size[k] >= free:
                release(k)
        hidden = covered()
    if all(hidden[k] for k in articles):
        for k, node in enumerate(nodes):
            if node.marked and node.tag not in FIRM and 2 * size[k] > size[0]:
                node.marked = False


# What lies deeper is not told apart.
DEEPEST = 40


class Block(NamedTuple):
    """A block of a page: path and text, the letters of it that are links, and whether the page's marks leave it in."""

    path: str
    text: str
    linked: int = 0
    kept: bool = True


def blocks(top: Node, chosen: list[Node] | None = None) -> list[Block]:
    """Every block in page order, white space folded, code and the page's head aside.

    A path names the elements from the page's root to the block, inline ones aside. Blocks in marked elements are not
    kept; with ``chosen`` only blocks below these elements are, which may be marked themselves.
    """
    found: list[Block] = []
    current: list[str] = []
    linked = 0
    roots = {id(node) for node in chosen or ()}

    def flush(path, kept):
        nonlocal linked
        text = " ".join("".join(current).split())
        current.clear()
        if text:
            found.append(Block(path, text, linked, kept))
        linked = 0

    # An explicit stack, as pages can be nested without end.
    stack: list = [(top, "", 0, chosen is None, False, iter(top.items))]
    while stack:
        node, path, depth, kept, link, items = stack[-1]
        for item in items:
            if isinstance(item, str):
                current.append(item)
                linked += len("".join(item.split())) if link else 0
                continue
            if item.tag == "br":
                current.append(" ")
                continue
            root = id(item) in roots
            inline = item.tag in INLINE
            if not inline:
                flush(path, kept)
            if item.tag in CODE or item.tag in HEADS or (inline and item.marked and not root):
                continue
            state = root or (kept and not item.marked), link or item.tag == "a", iter(item.items)
            if inline or depth >= DEEPEST:
                stack.append((item, path, depth, *state))
            else:
                stack.append((item, f"{path}/{item.kind}", depth + 1, *state))
            break
        else:
            stack.pop()
            if node.tag not in INLINE:
                flush(path, kept)
    flush("", chosen is None)
    return found


class Slot:
    """A node of an aligned tree: neighbours of one kind are one slot with the blocks of all."""

    __slots__ = ("kind", "blocks", "children", "shape", "size")

    def __init__(self, kind: str):
        self.kind, self.blocks, self.children = kind, [], []
        self.shape, self.size = 0, 1


def described(tree: Node) -> list[Block]:
    """All blocks of a page; those are kept that lie in its articles, if it marks any, and in no other marked element."""
    return blocks(tree, _chosen(tree) or None)


def own(page: list[Block]) -> tuple[tuple[str, str], ...]:
    """Path and text of the blocks that a page's own marks leave in."""
    return tuple((block.path, block.text) for block in page if block.kept)


def content(tree: Node) -> list[tuple[str, str]]:
    """The blocks that may be main text: of the articles if the page marks any, else of the whole page."""
    return list(own(described(tree)))


def slots(tree: Node) -> Slot:
    """The blocks of a page as a tree, in which runs of neighbours of one kind are folded."""
    return _folded(described(tree))


def _folded(page: list[Block]) -> Slot:
    """Slots of one page, each with a digest of the shape of its subtree, so that equal ones are known at once."""
    top = Slot("")
    for block in page:
        slot = top
        for kind in block.path.split("/")[1:]:
            if not slot.children or slot.children[-1].kind != kind:
                slot.children.append(Slot(kind))
            slot = slot.children[-1]
        slot.blocks.append(block)

    def digest(slot: Slot) -> int:
        parts = [slot.kind, *(str(digest(child)) for child in slot.children)]
        slot.shape = int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
        slot.size = 1 + sum(child.size for child in slot.children)
        return slot.shape

    digest(top)
    return top


def match(a: Slot, b: Slot, known: dict | None = None) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: the most nodes that can be paired in order, and the pairs.

    ``known`` keeps the size of a match and the places of the paired children, by the shapes of both.
    """
    known = {} if known is None else known
    if a.kind != b.kind:
        return 0, []
    pairs, stack = [], [(a, b)]
    while stack:
        one, other = stack.pop()
        pairs.append((one, other))
        stack += [(one.children[i], other.children[j]) for i, j in _matched(one, other, known)[1]]
    return len(pairs), pairs


def _matched(a: Slot, b: Slot, known: dict) -> tuple[int, list[tuple[int, int]]]:
    """The number of nodes that match, and the places of the children that are paired."""
    if a.kind != b.kind:
        return 0, []
    if a.shape == b.shape:
        return a.size, [(k, k) for k in range(len(a.children))]
    key = a.shape, b.shape
    if key not in known:
        places = _aligned(a.children, b.children, known)
        known[key] = 1 + sum(_matched(a.children[i], b.children[j], known)[0] for i, j in places), places
    return known[key]


def _aligned(a: list[Slot], b: list[Slot], known: dict) -> list[tuple[int, int]]:
    """Places of the paired children. Equal children at both ends are paired at once: no match is larger."""
    least, first, last = min(len(a), len(b)), 0, 0
    while first < least and a[first].shape == b[first].shape:
        first += 1
    while last < least - first and a[-1 - last].shape == b[-1 - last].shape:
        last += 1
    ends = [(k, k) for k in range(first)] + [(len(a) - 1 - k, len(b) - 1 - k) for k in range(last)]
    a, b = a[first : len(a) - last], b[first : len(b) - last]
    if not a or not b:
        return ends
    # What a pair of children is worth depends on their shapes alone.
    _, left, rows = np.unique([slot.shape for slot in a], return_index=True, return_inverse=True)
    _, right, columns = np.unique([slot.shape for slot in b], return_index=True, return_inverse=True)
    worth = np.array([[_matched(a[i], b[j], known)[0] for j in right] for i in left], np.int32)
    return ends + [(first + i, first + j) for i, j in _ordered_pairs(worth, rows, columns)]


def _row(before: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """The next row of the table of best sums."""
    out = before.copy()
    np.maximum(before[1:], before[:-1] + gains, out=out[1:])
    return np.maximum.accumulate(out, out=out)


def _ordered_pairs(worth: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """The pairs, in order, of the largest sum of ``worth``. A table that is too large is halved, and only its middle kept."""
    found, parts = [], [(0, len(rows), 0, len(columns))]
    while parts:
        top, bottom, start, end = parts.pop()
        if bottom == top or end == start:
            continue
        gains = worth[:, columns[start:end]]
        if bottom - top > 1 and (bottom - top) * (end - start) > CELLS:
            middle = (top + bottom) // 2
            upper = lower = np.zeros(end - start + 1, np.int32)
            for i in range(top, middle):
                upper = _row(upper, gains[rows[i]])
            for i in range(bottom - 1, middle - 1, -1):
                lower = _row(lower, gains[rows[i], ::-1])
            cut = start + int(np.argmax(upper + lower[::-1]))
            parts += [(top, middle, start, cut), (middle, bottom, cut, end)]
            continue
        table = [np.zeros(end - start + 1, np.int32)]
        for i in range(top, bottom):
            table.append(_row(table[-1], gains[rows[i]]))
        i, j = bottom - top, end - start
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((top + i, start + j))
    return found


class Wrapper(set):
    """Path and text of the template blocks of a host; ``within`` is the path of the element that holds the content."""

    within = ""


def induce(trees: list[Node]) -> Wrapper:
    """The wrapper of pages of one host."""
    return induce_blocks([described(tree) for tree in trees])


def induce_blocks(found: list[list[Block]]) -> Wrapper:
    """The same from the pages' blocks. Pages with the same kept blocks are copies and count as one."""
    different: dict[tuple, list[Block]] = {}
    for page in found:
        different.setdefault(own(page), page)
    if len(different) < LEAST_PAGES:
        return Wrapper()
    folded = [_folded(page) for page in different.values()]
    paths: dict[int, str] = {}

    def name(slot: Slot, path: str) -> None:
        paths[id(slot)] = path
        for child in slot.children:
            name(child, f"{path}/{child.kind}")

    reference = max(folded, key=lambda slot: slot.size)
    name(reference, "")
    having: Counter[str] = Counter()
    times: Counter[tuple[str, str]] = Counter()
    aligned: list[dict[str, list[Block]]] = []
    known: dict[tuple[int, int], int] = {}
    for page in folded:
        at: dict[str, list[Block]] = {}
        for slot, other in match(reference, page, known)[1]:
            at.setdefault(paths[id(slot)], []).extend(other.blocks)
        having.update(at.keys())
        times.update((path, text) for path, inside in at.items() for text in {block.text for block in inside})
        aligned.append(at)
    # Folded neighbours are judged one by one: a block is template by the share of pages that have it in its slot.
    wrapper = Wrapper(
        (path, text)
        for (path, text), n in times.items()
        if having[path] >= LEAST_PAGES and n >= CONSTANT * having[path]
    )
    wrapper.within = _content_path(aligned, wrapper)
    return wrapper


def _content_path(aligned: list[dict[str, list[Block]]], template: set[tuple[str, str]]) -> str:
    """The path of the innermost element that holds nearly all varying text outside of links; every page counts the same.

    No element is chosen that is a paragraph itself, nor one whose text the pages' marks mostly leave out.
    """
    weight: Counter[str] = Counter()
    spared: Counter[str] = Counter()
    for at in aligned:
        free = [
            (path, block.kept, max(0, len("".join(block.text.split())) - block.linked))
            for path, inside in at.items()
            for block in inside
            if (path, block.text) not in template
        ]
        total = sum(size for _, _, size in free)
        for path, kept, size in free:
            weight[path] += size / total if total else 0
            spared[path] += size / total if total and kept else 0
    needed = DOMINANT * sum(weight.values())
    within = ""
    while needed:
        below: Counter[str] = Counter()
        left: Counter[str] = Counter()
        for path in weight:
            if path.startswith(within + "/"):
                child = f"{within}/{path[len(within) + 1 :].split('/', 1)[0]}"
                below[child] += weight[path]
                left[child] += spared[path]
        if not below:
            break
        child = max(below, key=lambda path: (below[path], path))
        if below[child] < needed or 2 * weight[child] >= below[child] or 2 * left[child] < below[child]:
            break
        within = child
        if _tag(child) in ARTICLE:
            break
    return within


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _articles(tree: Node) -> list[Node]:
    """The outermost articles that lie in no marked element."""
    found, stack = [], [tree]
    while stack:
        node = stack.pop()
        if node.marked and node.tag not in ARTICLE:
            continue
        if node.tag in ARTICLE:
            found.append(node)
            continue
        stack += [item for item in reversed(node.items) if isinstance(item, Node)]
    return found


def _chosen(tree: Node) -> list[Node]:
    """The elements that the page marks as its articles, if any."""
    marked = _articles(tree)
    if any("main" == node.tag for node in marked):
        inner = [a for node in marked if node.tag == "main" for a in _inside(node)]
        marked = inner or marked
    return marked


def main_text(tree: Node, wrapper: set[tuple[str, str]]) -> str:
    """The text of the blocks that both the page's marks and the wrapper leave in, joined by line feeds."""
    return kept_text(content(tree), wrapper)


def kept_text(found: list[tuple[str, str]], wrapper: set[tuple[str, str]]) -> str:
    """A page of another build, with nothing in the element that holds the host's content, keeps all but the template."""
    left = [(path, text) for path, text in found if (path, text) not in wrapper]
    within = getattr(wrapper, "within", "")
    inside = [path == within or path.startswith(within + "/") for path, _ in left]
    if any(inside):
        left = [block for block, holds in zip(left, inside) if holds or _beside(block[0], within)]
    return "\n".join(text for _, text in left)


def _beside(path: str, within: str) -> bool:
    """Whether a block is a page's title, or text or a paragraph of an element around the content."""
    around, _, _ = path.rpartition("/")
    tag = _tag(path)
    return tag == "h1" or f"{within}/".startswith(f"{path}/") or (tag in PROSE and f"{within}/".startswith(f"{around}/"))


def _inside(node: Node) -> list[Node]:
    below = Node("", "", False)
    below.items = node.items
    return _articles(below)


def chunks(rows):
    """Chunks of pages of one group, each with its wrapper, from (group, row, blocks) ordered by group.

    A chunk is a list of (kept blocks, rows): rows with the same kept blocks are copies, which take one place. A group's pages are
    spread evenly, so that its last chunk is no small rest. Where too many copies wait, the chunk ends early; a rest of
    fewer pages than a wrapper needs then takes that of the chunk before.
    """
    held: dict[tuple, list] = {}
    whole: dict[tuple, list[Block]] = {}
    group, waiting, wrapper = None, 0, Wrapper()

    def take(n: int):
        nonlocal waiting, wrapper
        part = [(kept, held.pop(kept)) for kept in list(held)[:n]]
        pages = [whole.pop(kept) for kept, _ in part]
        waiting -= sum(len(same) for _, same in part)
        if len(part) >= LEAST_PAGES:
            wrapper = induce_blocks(pages)
        return part, wrapper

    def rest():
        if held:
            half = len(held) if len(held) <= CHUNK else (len(held) + 1) // 2
            yield take(half)
        if held:
            yield take(len(held))

    for key, row, found in rows:
        if key != group:
            yield from rest()
            group, wrapper = key, Wrapper()
        page = [Block(*block) for block in found]
        whole.setdefault(own(page), page)
        held.setdefault(own(page), []).append(row)
        waiting += 1
        if len(held) >= 2 * CHUNK:
            yield take(CHUNK)
        elif waiting >= HELD_ROWS:
            yield from rest()
    yield from rest()


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages``: the main text of its whole html, empty if there is none.

    A null html counts as empty; pages without a url form a host of their own. Rows may repeat. Only the three columns
    are read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    named = pages.select("page_id", "url", "html", host.alias("host"))
    counts = named.groupBy("host").agg(F.count("*").alias("rows"))
    total = max(1, pages.count())
    # Hosts with more than a SHAREth of all pages: fewer than SHARE of them.
    splits = F.least(F.ceil(F.col("rows") * SHARE / total), F.floor(F.col("rows") / SPLIT_ROWS))
    hot = counts.where(F.col("rows") * SHARE > total).select("host", F.greatest(splits, F.lit(1)).cast("int").alias("splits"))
    split = F.coalesce(F.pmod(F.xxhash64("page_id"), "splits"), F.lit(0))
    dealt = named.join(F.broadcast(hot), "host", "left").withColumn("split", split).drop("splits")
    keys = ["host", "split"]
    spread = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    ordered = spread.sortWithinPartitions(*keys, "page_id").select(*keys, "page_id", "url", "html")

    def run(batches):
        import pyarrow as pa

        def extract(chunk, wrapper):
            rows = [(*row, text) for found, same in chunk for text in [kept_text(found, wrapper)] for row in same]
            for at in range(0, len(rows), BATCH_ROWS):
                ids, urls, texts = zip(*rows[at : at + BATCH_ROWS])
                yield pa.RecordBatch.from_pydict(
                    {
                        "page_id": pa.array(ids, pa.int64()),
                        "url": pa.array(urls, pa.string()),
                        "text": pa.array(texts, pa.string()),
                    }
                )

        for chunk, wrapper in chunks(groups(batches)):
            yield from extract(chunk, wrapper)

    def groups(batches):
        for batch in batches:
            for host_name, part, page_id, url, html in zip(*(column.to_pylist() for column in batch.columns)):
                yield (host_name, part), (page_id, url), described(parse(html or ""))

    return ordered.mapInArrow(run, "page_id long, url string, text string")
