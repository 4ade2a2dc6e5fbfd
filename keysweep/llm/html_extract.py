"""HTML extraction: the main text of pages, by boosted trees over DOM nodes and a choice that fits the whole tree.

Every element and every run of text gets features: density of its subtree (characters, elements, links, sentence marks), tag,
words of its class, id and role attributes and of those around it, depth, place in the page, and its siblings. Boosted trees
give each the odds that it holds main text. Decoding takes the set of nodes with the greatest sum of log-odds in which a
chosen node's parent is chosen as well, so a choice below a rejected ancestor cannot happen.

No page comes with its main text marked, so the trees learn from pages that are laid out here: the texts of a bounded
sample of the given pages (``most_pages``, the first by a hash of the identifier) are put into many layouts of articles, menus,
headers, footers, sidebars, notices, adverts, forms and reader comments, with and without telling names. The trees see
structure only, never words of the text. Every page is scored.

Text: character references are decoded, white space in a block becomes one space, blocks are joined by line breaks in page order.

Cases: NULL or empty html gives an empty text; markup that is cut off or badly nested is read as far as it goes; rows that
repeat an identifier are extracted one by one; an empty table gives an empty result; other columns are not read. Memory is
bounded by the longest page.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm import boosting
from keysweep.llm.dom import Page
from keysweep.llm.layouts import MARK, laid_out
from keysweep.llm.staging import bounded_sample
from keysweep.llm.text import batch_of, map_pieces

MOST_PAGES = 300
LAYOUTS = 600

# Words of attributes that tell what an element is for.
GOOD = frozenset("article articles body content entry main post story text hentry page prose chapter read reader blog news copy".split())
BAD = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumbs tabs toolbar pagination pager paging skip topnav subnav",
    "frame": "header masthead topbar logo branding footer foot copyright colophon legal bottom credits",
    "side": "sidebar side aside related recommended recommendations popular trending widget widgets rail more also tags tagcloud archive archives teaser",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription banner toast dialog paywall privacy",
    "advert": "ad ads advert advertisement advertising adsense sponsor sponsored promo promotion promoted dfp outbrain taboola banner affiliate",
    "form": "form search login signup signin register contact field input",
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback reviews review thread responses",
    "share": "share sharing social follow facebook twitter buttons byline author meta metadata date print rating",
}
BAD_OF = {w: k for k, words in BAD.items() for w in words.split()}
TAG_GROUPS = {
    "nav": "nav menu",
    "frame": "header footer",
    "aside": "aside dialog",
    "form": "form fieldset legend",
    "article": "article main",
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "paragraph": "p blockquote pre address",
    "item": "li dt dd",
    "list": "ul ol dl",
    "plain": "div section center body html details summary",
    "table": "table thead tbody tfoot tr td th caption",
    "figure": "figure figcaption",
}
GROUP_OF = {t: i for i, tags in enumerate(TAG_GROUPS.values()) for t in tags.split()}
AROUND = tuple(list(TAG_GROUPS).index(g) for g in ("nav", "frame", "aside", "form", "article"))
SENTENCE = ".!?…。！？"


def node_features(pages: Sequence[Page]) -> np.ndarray:
    """One row for each node of all pages; runs have the tag and the attributes of their element."""
    sizes = np.array([len(p.tags) for p in pages])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    join = lambda name, kind: np.fromiter((x for p in pages for x in getattr(p, name)), kind, int(sizes.sum()))
    parent = np.maximum(join("parents", np.int64), 0) + base
    end, depth, links = join("ends", np.int64) + base, join("depths", np.int64), join("links", np.int64)
    texts = [t for p in pages for t in p.texts]
    tags = [t for p in pages for t in p.tags]
    run = np.fromiter((not t for t in tags), bool, len(tags))
    chars = np.fromiter(map(len, texts), np.int64, len(texts))
    marks = np.fromiter((sum(map(t.count, SENTENCE)) if t else 0 for t in texts), np.int64, len(texts))
    commas = np.fromiter((t.count(",") if t else 0 for t in texts), np.int64, len(texts))
    group = np.fromiter((GROUP_OF.get(t, -1) for t in tags), np.int64, len(tags))
    group = np.where(run, group[parent], group)
    kinds = list(BAD)
    own = np.zeros((len(tags), len(kinds) + 1))
    at = 0
    for p in pages:
        for i, tokens in enumerate(p.tokens):
            for t in tokens:
                if t in GOOD:
                    own[at + i, -1] += 1
                if t in BAD_OF:
                    own[at + i, kinds.index(BAD_OF[t])] += 1
        at += len(p.tags)
    own = np.minimum(own, 2)
    own[run] = own[parent[run]]

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[end] - sums[np.arange(len(values))]

    # Names and tags of all ancestors, level by level from the root.
    above = np.zeros((len(tags), len(kinds) + 1 + len(AROUND)))
    here = np.concatenate([own, np.stack([group == g for g in AROUND], axis=1)], axis=1)
    order = np.argsort(depth, kind="stable")
    levels = np.searchsorted(depth[order], np.arange(int(depth.max(initial=0)) + 2))
    for level in range(1, len(levels) - 1):
        rows = order[levels[level] : levels[level + 1]]
        above[rows] = np.maximum(above[parent[rows]], np.where(run[parent[rows], None], 0, here[parent[rows]]))
    total = below(chars)
    page_total = np.maximum(total[base], 1)
    before = np.concatenate([[0], np.cumsum(chars)])[:-1]
    elements, runs = below(~run), np.maximum(below(run), 1)
    whole = np.maximum(total, 1)
    siblings = np.bincount(parent, minlength=len(tags))[parent]
    by_tag = parent * (len(TAG_GROUPS) + 1) + group + 1
    _, inverse, counts = np.unique(by_tag, return_inverse=True, return_counts=True)
    sibling_chars = np.bincount(parent, total, len(tags))[parent]
    columns = [
        run,
        depth,
        np.log1p(total),
        below(links) / whole,
        np.log1p(total / (elements + 1)),
        below(marks) / whole * 100,
        below(commas) / whole * 100,
        np.log1p(total / runs),
        total / page_total,
        (before - before[base]) / page_total,
        np.log1p(page_total),
        np.log1p(siblings),
        counts[inverse] / np.maximum(siblings, 1),
        np.log1p((sibling_chars - total) / np.maximum(siblings - 1, 1)),
        total / np.maximum(sibling_chars, 1),
        (before + chars >= before[base] + page_total),
        *[group == g for g in range(len(TAG_GROUPS))],
    ]
    return np.concatenate([np.stack(columns, axis=1).astype(float), own, above], axis=1)


def chosen_runs(page: Page, odds: Sequence[float]) -> list[int]:
    """Runs of the set of nodes of the greatest sum of log-odds that holds the parent of each of its nodes."""
    best = list(odds)
    for i in range(len(best) - 1, 0, -1):
        if best[i] > 0:
            best[page.parents[i]] += best[i]
    taken, out = [best[0] > 0], []
    for i in range(1, len(best)):
        taken.append(best[i] > 0 and taken[page.parents[i]])
        if taken[i] and not page.tags[i]:
            out.append(i)
    return out


def run_labels(page: Page) -> np.ndarray:
    """For laid out pages: whether a node is, or holds, main text."""
    own = np.fromiter((t.startswith(MARK) for t in page.texts), np.int64, len(page.texts))
    sums = np.concatenate([[0], np.cumsum(own)])
    page.texts = [t.removeprefix(MARK) for t in page.texts]
    return (sums[page.ends] - sums[np.arange(len(own))] > 0).astype(float)


def fit(htmls: Sequence[str], layouts: int = LAYOUTS) -> boosting.Trees:
    """Trees that learned from the texts of ``htmls`` in ``layouts`` layouts."""
    texts = [t for html in htmls for t in Page(html).texts if t]
    pages = [Page(html) for html in laid_out(texts, layouts)]
    labels = np.concatenate([run_labels(p) for p in pages])
    return boosting.train(node_features(pages), labels, trees=60, depth=5, rate=0.2, least=20)


def html_extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most_pages: int = MOST_PAGES
) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points)."""
    sample = pages.filter(column(html_col).isNotNull()).select(column(id_col).alias("id"), column(html_col).alias("html"))
    sample = bounded_sample(sample, most_pages, F.col("id"), F.xxhash64("html")).select("html").collect()
    shared = pages.sparkSession.sparkContext.broadcast(fit([r.html for r in sample]))

    def extract(piece: pa.RecordBatch) -> pa.RecordBatch:
        read = [Page(h or "") for h in piece.column("html").to_pylist()]
        odds = shared.value.score(node_features(read)).tolist()
        at, texts = 0, []
        for page in read:
            runs = chosen_runs(page, odds[at : at + len(page.tags)])
            at += len(page.tags)
            texts.append("\n".join([page.texts[i] for i in runs]))
        return batch_of(
            page_id=piece.column("id"),
            url=piece.column("url"),
            text=pa.array(texts, pa.string()),
            n_chars=np.fromiter(map(len, texts), np.int64, len(texts)),
        )

    rows = pages.select(
        column(id_col).cast("bigint").alias("id"), column(url_col).cast("string").alias("url"), column(html_col).alias("html")
    )
    return map_pieces(rows, ["id", "url", "html"], extract, "page_id long, url string, text string, n_chars long", text="html")
