"""HTML extraction: the maximum-scoring run of words and tags is the main text.

A page is a sequence of words and tags. Words score by how likely a word of its
surroundings is content, tags score negative by kind, and a linear scan finds the
contiguous run with the highest sum. Weights are log-odds counted on labelled pages:
pages that mark their main text themselves, by an ``article`` or ``main`` element,
label every token as inside or outside. The weights need not see that element again,
as they describe a word's neighbourhood only: the kinds of the open elements, the share
of link words in its block and the length of the block.

What is never main text (scripts, styles, forms, menus, asides, notices, adverts,
comments) is recognised by element, role or the words of class and id, and left out of
the run even if the run goes on behind it. A form, or an element that only a word of its
class or id calls noise, is none if it stands around the whole page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.llm.common import by_value, lean, slices, unit

#: Bound of the labelled sample: pages that the weights are learned from.
SAMPLE_PAGES = 400
_BATCH_BYTES = 16 << 20

#: Elements whose content is text of no kind.
RAW = frozenset("script style noscript template svg math iframe object canvas select option textarea head title".split())
#: Elements that hold no content of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold main text.
OUTSIDE = frozenset("nav header footer aside form button dialog menu label fieldset".split())
#: Elements inside a block; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Roles and words in class or id that tell what never holds main text.
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promoted promotion comment comments "
    "commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification popup modal overlay newsletter "
    "subscribe subscription signup login sidebar aside rail widget widgets related recommended recommendations nav navbar navigation "
    "menu menus breadcrumb breadcrumbs pagination pager footer masthead topbar share sharing social skip toolbar".split()
)
#: Noise by a word of class or id and forms may stand around a whole page, other noise may not.
HARD, SOFT = "hard", "soft"
#: A block of so many words outside links is text.
TEXT_WORDS = 20
#: Elements of the head; any other one closes it.
HEAD = frozenset("base link meta noscript script style template title".split())
#: Elements that close an open one of the same kind, or of the kinds named.
CLOSES = {"li": "li", "p": "p", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th"}

by_value(__name__)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_SPACE = re.compile(r"\s+")


def _noise(tag: str, attributes: str) -> str:
    """Whether an element never holds main text, by its name or attributes: HARD, SOFT or empty."""
    if tag in OUTSIDE and tag != "form":
        return HARD
    found = SOFT if tag == "form" else ""
    if not attributes or attributes.isspace():
        return found
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return HARD
        if name == "role" and value.lower() in ROLES:
            return HARD
        if name in ("class", "id") and any(p.lower() in NOISE for p in _PARTS.findall(value)):
            found = SOFT
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return HARD
    return found


class Piece:
    """A block's text, or a part of it between tags, with what surrounds it."""

    __slots__ = ("text", "block", "noise", "linked", "marked", "within")

    def __init__(self, text: str, block: int, noise: bool, linked: bool, marked: bool, within: tuple = ()):
        """``within``: numbers of the open elements of soft noise, outermost first."""
        self.text, self.block, self.noise, self.linked, self.marked, self.within = text, block, noise, linked, marked, within


def tokens(page: str) -> list:
    """A page as pieces of text and tag names ("/" before the name of an end tag)."""
    out, stack, at, block = [], [], 0, 0
    noise = linked = marked = raw = 0
    size, until = len(page), None
    within, softs, begun = (), 0, -1

    def text(upto: int) -> None:
        nonlocal begun
        if upto > at and not raw:
            part = page[at:upto]
            # White space parts words whatever tags stand around it; only before a block's first text it is none.
            if not part.isspace():
                out.append(Piece(html.unescape(part), block, noise > 0, linked > 0, marked > 0, within))
                begun = block
            elif begun == block:
                out.append(Piece(" ", block, noise > 0, linked > 0, marked > 0, within))

    def pop() -> str:
        nonlocal noise, linked, marked, raw, within
        tag, flags, within = stack.pop()
        noise, linked, marked, raw = (x - y for x, y in zip((noise, linked, marked, raw), flags))
        return tag

    def push(tag: str, attributes: str) -> None:
        nonlocal noise, linked, marked, raw, within, softs
        # The heading of an article belongs to it, a page header does not.
        exempt = (tag == "header" and marked) or tag in ("html", "body", "article", "main")
        bad = "" if exempt else _noise(tag, attributes)
        flags = (int(bad == HARD), int(tag == "a"), int(tag in ("article", "main")), int(tag in RAW))
        stack.append((tag, flags, within))
        if bad == SOFT:
            softs += 1
            within = (*within, softs)
        noise, linked, marked, raw = (x + y for x, y in zip((noise, linked, marked, raw), flags))

    place = 0
    while True:
        if until:
            # Raw text goes to its end tag, whatever looks like a tag before.
            end = re.compile(rf"</{until}(?=[\s/>]|\Z)", re.I).search(page, place)
            place = end.start() if end else size
        found = _TOKEN.search(page, place)
        if not found:
            text(size)
            break
        tag = (found[2] or "").lower()
        text(found.start())
        at = place = found.end()
        until = None
        if not tag:
            continue
        if tag not in INLINE:
            block += 1
        out.append(("/" if found[1] else "") + tag)
        if found[1]:
            if any(t == tag for t, *_ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        # The end tag of the head may be left out.
        if stack and (stack[-1][0] == "head" and tag not in HEAD or tag == "body" and any(t == "head" for t, *_ in stack)):
            while pop() != "head":
                pass
        if tag not in VOID and not (found[3] or "").rstrip().endswith("/"):
            if tag in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in (tag, CLOSES[tag]):
                        while len(stack) > k:
                            pop()
                        break
                    if stack[k][0] not in INLINE and stack[k][0] != "p":
                        break
            push(tag, found[3] or "")
            if tag in ("script", "style", "textarea", "title", "noscript", "iframe"):
                until = tag
    if softs:
        _settle([x for x in out if isinstance(x, Piece)])
    return out


def _settle(pieces: list[Piece]) -> None:
    """Call pieces within soft noise noise, but for elements that stand around the whole page.

    Such an element holds most words and text of its own. If it holds marked text, all
    marked text is in it, else no block of text is outside. Outer elements come first.
    """
    sizes = [len(x.text.split()) for x in pieces]
    words: Counter = Counter()
    blocks: Counter = Counter()
    for x, n in zip(pieces, sizes):
        if not x.noise:
            blocks[x.block] += n * (not x.linked)
            for k in x.within:
                words[k] += n
    total = sum(n for x, n in zip(pieces, sizes) if not x.noise)
    around: set[int] = set()
    for k in sorted(k for k in words if 2 * words[k] > total):
        # Text that nothing else makes noise, inside or outside.
        clean = [x for x in pieces if not x.noise and all(j == k or j in around for j in x.within if j <= k)]
        inside = [x for x in clean if k in x.within]
        outside = [x for x in clean if k not in x.within and all(j in around for j in x.within)]
        if any(x.marked for x in inside):
            whole = not any(x.marked for x in outside)
        else:
            is_text = lambda x: x.marked or (not x.linked and blocks[x.block] >= TEXT_WORDS)
            whole = any(map(is_text, inside)) and not any(map(is_text, outside))
        if whole:
            around.add(k)
    for x in pieces:
        x.noise = x.noise or any(k not in around for k in x.within)


def _blocks(sequence: list) -> dict[int, tuple[int, int]]:
    """Words and link words of each block."""
    counts: dict[int, list[int]] = {}
    for x in sequence:
        if isinstance(x, Piece):
            n = len(x.text.split())
            own = counts.setdefault(x.block, [0, 0])
            own[0] += n
            own[1] += n * x.linked
    return counts


def feature(piece: Piece, counts: dict) -> str:
    """The neighbourhood of a word: noise, share of links, length of its block."""
    words, linked = counts[piece.block]
    length = "short" if words < 5 else "middle" if words < 20 else "long"
    return f"{'noise' if piece.noise else 'link' if 2 * linked > words else 'text'} {length}"


#: Log-odds of a word are kept within the first, so that no kind decides alone; a tag costs between the next two.
MOST_WORD, LEAST_TAG, MOST_TAG = 1.0, 0.1, 1.0
#: Recognised noise is left out anyway, so a stretch of it costs a run no more than this: text goes on behind an advert.
MOST_NOISE = 1.0


def learn(pages: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of words by neighbourhood and of tags by kind, from pages with marked main text."""
    words, tags = (Counter(), Counter()), (Counter(), Counter())
    for page in pages:
        sequence = tokens(page)
        counts = _blocks(sequence)
        inside = [i for i, x in enumerate(sequence) if isinstance(x, Piece) and x.marked]
        if not inside:
            continue
        for i, x in enumerate(sequence):
            if isinstance(x, Piece):
                words[x.marked and not x.noise][feature(x, counts)] += len(x.text.split())
            else:
                tags[inside[0] < i < inside[-1]][x.lstrip("/")] += 1
    odds = lambda pair, key: log((pair[1][key] + 1) / (pair[0][key] + 1))
    word = {k: max(-MOST_WORD, min(MOST_WORD, odds(words, k))) for k in {*words[0], *words[1]}}
    tag = {k: -max(LEAST_TAG, min(MOST_TAG, LEAST_TAG - odds(tags, k))) for k in {*tags[0], *tags[1]}}
    return word, tag


#: What holds for kinds that the labelled pages do not show.
PRIOR = {"noise": -1.0, "link": -1.0, "text short": 0.3, "text": 1.0}
PRIOR_TAG = -0.5


def _word_weight(kind: str, weights: dict[str, float]) -> float:
    prior = PRIOR.get(kind, PRIOR[kind.split()[0]])
    # Noise and links stay negative, plain text positive, whatever a sample of one site shows.
    found = weights.get(kind, prior)
    return min(found, -0.5) if prior < 0 else max(found, 0.2)


def extract(page: str | None, weights: tuple[dict, dict]) -> str:
    """The text of the best run: blocks in order, joined by one space; empty if no word scores."""
    if not page:
        return ""
    sequence = tokens(page)
    counts = _blocks(sequence)
    word, tag = weights
    best, best_run, total, start = 0.0, (0, 0), 0.0, 0
    for i, x in enumerate(sequence):
        if isinstance(x, Piece):
            score = _word_weight(feature(x, counts), word) * len(x.text.split())
            score = max(score, -MOST_NOISE) if x.noise else score
        else:
            score = tag.get(x.lstrip("/"), PRIOR_TAG) * (0.1 if x.lstrip("/") in INLINE else 1.0)
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_run = total, (start, i + 1)
    first, last = _whole_article(sequence, *best_run)
    blocks: dict[int, list[str]] = {}
    for x in sequence[first:last]:
        if isinstance(x, Piece) and not x.noise:
            blocks.setdefault(x.block, []).append(x.text)
    joined = (_SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return " ".join(t for t in joined if t)


def _whole_article(sequence: list, first: int, last: int) -> tuple[int, int]:
    """The run, grown to the ends of the marked element that most of its words are in; nothing is cut away."""
    inside = outside = 0
    for x in sequence[first:last]:
        if isinstance(x, Piece) and not x.noise:
            inside, outside = (inside + len(x.text), outside) if x.marked else (inside, outside + len(x.text))
    if inside <= outside:
        return first, last
    marked = [i for i, x in enumerate(sequence) if isinstance(x, Piece) and x.marked]
    middle = [i for i in marked if first <= i < last]
    low, high = middle[0], middle[-1]
    where = set(marked)
    gap = lambda i: not isinstance(sequence[i], Piece) and sequence[i] not in ("article", "main", "/article", "/main")
    while low > 0 and (low - 1 in where or gap(low - 1)):
        low -= 1
    while high + 1 < len(sequence) and (high + 1 in where or gap(high + 1)):
        high += 1
    return min(first, low), max(last, high + 1)


def labelled_sample(pages: DataFrame, most: int = SAMPLE_PAGES) -> list[str]:
    """Up to ``most`` pages that mark their main text, the same for the same rows."""
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]")).select("html", unit("page", F.col("page_id")).alias("_u"))
    n = marked.count()
    drawn = marked.where(F.col("_u") < F.lit(min(1.0, 2 * most / max(1, n)))).orderBy("_u", "html").limit(most)
    return [row["html"] for row in drawn.select("html").collect()]


def main_text(pages: DataFrame, weights: tuple[dict, dict]) -> DataFrame:
    """Per row: ``page_id, url, text, n_chars``.

    ``text`` is empty for a null or blank page and for one without main text; it is never
    cut. Other columns are ignored, repeated rows give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _BATCH_BYTES, "html"):
            texts = [extract(page, weights) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(lean(run), "page_id long, url string, text string, n_chars long")
