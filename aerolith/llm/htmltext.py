"""HTML extraction: a linear-chain conditional random field over DOM leaf blocks.

A page becomes its leaf blocks, runs of text between block-level tags, with the open tags, classes and ids above each.
Features of ancestors and text feed a chain with two labels, boilerplate and article, that is trained by maximum
likelihood on labelled pages and decoded by Viterbi. Names that training never saw have no weight: such blocks are told by
whether they stand in the page's article or main part, or else by their container's part in the page. Scripts, styles, comments and the head's markup are no text.

A page costs time in proportion to its length: tags end at a bounded search, and a block's ancestors are a set that siblings share.

Defined cases: null and empty html give an empty text; tags may be unclosed, nested wrongly or cut off at the end; a
"<" that starts no tag is text; pages of any length are read whole; repeated rows are read one by one.
"""

from __future__ import annotations

import collections
import functools
import html
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"""["'>]""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = frozenset("script style textarea title noscript iframe template svg math".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("html head body address article aside blockquote button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
_HOLDS = frozenset("body article main section div aside td".split())
_CLOSES_P = _BLOCK - {"html", "head", "body", "button", "label", "option", "select", "td", "th", "tr", "caption", "legend", "summary"}
_SELF = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}


def tags(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before, tag, whether it closes, attributes) of each tag, the last with what follows it; in linear time.

    Quotes hide a ">", until a quote that never ends: from there on, a tag ends at its first ">".
    """
    at, text, n, quotes, last = 0, 0, len(page), True, page.rfind(">")
    while at < n and (m := _OPEN.search(page, at)):
        if m.start() > last:
            break
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            yield page[text : m.start()], "", False, ""
            at = text = n if end < 0 else end + 3
            continue
        end = page.find(">", m.end())
        if m[2] and quotes:
            k = m.end()
            while (s := _STOP.search(page, k)) and s[0] != ">":
                if (k := page.find(s[0], s.end()) + 1) == 0:
                    s = None
                    break
            if s:
                end = s.start()
            else:
                quotes = False
        tag, shut, rest = (m[2] or "").lower(), bool(m[1]), page[m.end() : end] if m[2] else ""
        yield page[text : m.start()], tag, shut, rest
        at = text = end + 1
        if tag in _RAW and not shut and not rest.endswith("/"):
            close = re.compile(rf"</{tag}\b", re.I).search(page, at)
            end = page.find(">", close.end()) if close else -1
            at = text = n if end < 0 else end + 1
    yield page[text:], "", False, ""


class Block(NamedTuple):
    text: str
    names: frozenset[str]  # open tags, and their class and id names with a dot before
    leaf: str  # the innermost open tag
    linked: int  # characters inside links
    holder: int  # number of the nearest container


def leaf_blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """Each block in page order; names only of those known, where given, so that a block costs no more however deep it lies."""
    out: list[Block] = []
    none: frozenset[str] = frozenset()
    stack: list[tuple[str, frozenset[str], int]] = []
    parts: list[str] = []
    open_tags: collections.Counter[str] = collections.Counter()
    linked, holders = 0, 0

    def close():
        nonlocal parts, linked
        if parts and (text := " ".join("".join(parts).split())):
            leaf, names, holder = stack[-1] if stack else ("", none, 0)
            out.append(Block(text, names, leaf, min(linked, len(text)), holder))
        parts, linked = [], 0

    def pop(i: int):
        for tag, _, _ in stack[i:]:
            open_tags[tag] -= 1
        del stack[i:]

    for raw, tag, shut, rest in tags(page):
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if open_tags["a"]:
                linked += len(text)
        if not tag or tag in _RAW and not shut and not rest.endswith("/"):
            continue
        if tag == "br":
            parts.append(" ")
        if tag in _BLOCK:
            close()
        if shut:
            if open_tags[tag]:
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                pop(i)
            continue
        if tag in _CLOSES_P or tag in _SELF:
            twins = {"p"} if tag in _CLOSES_P else set()
            twins |= {tag, _SELF[tag]} if tag in _SELF else set()
            for i in range(len(stack) - 1, max(-1, len(stack) - 12), -1):
                if stack[i][0] in twins:
                    pop(i)
                    break
                if stack[i][0] in _BLOCK and stack[i][0] != "p":
                    break
        if tag not in _VOID and not rest.endswith("/"):
            own = {"." + w for v in _NAMES.findall(rest) for w in re.split(r"[^a-z]+", "".join(v).lower()) if w} if "=" in rest else set()
            own.add(tag)
            if known is not None:
                own &= known
            _, names, holder = stack[-1] if stack else ("", none, 0)
            if tag in _HOLDS:
                holders += 1
                holder = holders
            stack.append((tag, names if own <= names else names | own, holder))
            open_tags[tag] += 1
    close()
    return out


def block_features(blocks: list[Block]) -> list[list[str]]:
    """Names of what holds for each block: its ancestors, its text, and its container's part in the page.

    A container's part is its own unlinked text against the page's largest, and whether the block comes before or after that one.
    """
    said: collections.Counter[int] = collections.Counter()
    for b in blocks:
        said[b.holder] += len(b.text) - b.linked
    top, most = max(said.items(), key=lambda kv: (kv[1], -kv[0]), default=(0, 0))
    inside = {t: any(t in b.names for b in blocks) for t in ("article", "main")}
    core = next((t for t in ("article", "main") if inside[t]), None)
    first = next((i for i, b in enumerate(blocks) if b.holder == top), 0)
    last = next((len(blocks) - 1 - i for i, b in enumerate(reversed(blocks)) if b.holder == top), 0)
    out = []
    for i, (text, names, leaf, linked, holder) in enumerate(blocks):
        n = len(text)
        size = "%d" % min(8, n.bit_length())
        where = "core" if core and core in names else "beside" if core else "top" if holder == top else "other"
        f = ["bias", "len:" + size, "link:%d" % (4 * linked // max(1, n)), "leaf:" + leaf, "where:" + where, "where-len:" + where + size]
        f += ["in:" + p for p in names]
        f.append("end:" + ("stop" if text[-1] in ".!?…»”\"" else "none"))
        if "©" in text or text.lower().startswith("copyright"):
            f.append("copyright")
        f.append("share:%d" % min(7, 8 * said[holder] // max(1, most)) + where)
        f.append("side:" + ("before" if i < first else "after" if i > last else "within") + where)
        out.append(f)
    return out


class ChainField:
    """Two labels; weights of features and of label pairs."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, pairs: np.ndarray):
        self.names, self.weights, self.pairs = names, weights, pairs
        self.known = frozenset(n[3:] for n in names if n.startswith("in:"))

    def scores(self, features: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(features), 2))
        for row, f in zip(out, features):
            known = [self.names[x] for x in f if x in self.names]
            row += self.weights[known].sum(0)
        return out

    def viterbi(self, features: list[list[str]]) -> list[int]:
        """The likeliest labels; ties go to article."""
        if not features:
            return []
        e = self.scores(features).tolist()
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b = e[0]
        back = []
        for x, y in e[1:]:
            f0, f1 = (0, a + p00) if a + p00 > b + p10 else (1, b + p10)
            t0, t1 = (0, a + p01) if a + p01 > b + p11 else (1, b + p11)
            back.append((f0, t0))
            a, b = f1 + x, t1 + y
        label = 0 if a > b else 1
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    @staticmethod
    def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 150, rate: float = 0.1, l2: float = 1e-3) -> ChainField:
        """Maximum likelihood by forward-backward over all pages at once; pages are padded to the longest."""
        pages = [p for p in pages if p[0]]
        names: dict[str, int] = {}
        for feats, _ in pages:
            for f in feats:
                for x in f:
                    names.setdefault(x, len(names))
        n, longest = len(pages), max(len(f) for f, _ in pages)
        live = np.zeros((n, longest), bool)
        gold = np.zeros((n, longest), np.int64)
        rows, cols = [], []
        for i, (feats, labels) in enumerate(pages):
            live[i, : len(feats)] = True
            gold[i, : len(feats)] = labels
            for t, f in enumerate(feats):
                rows += [i * longest + t] * len(f)
                cols += [names[x] for x in f]
        rows, cols = np.array(rows), np.array(cols)
        weights, pairs = np.zeros((len(names), 2)), np.zeros((2, 2))
        moments = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros_like(pairs), np.zeros_like(pairs)]]
        flat_gold = np.eye(2)[gold.ravel()] * live.ravel()[:, None]
        both = live[:, 1:] & live[:, :-1]
        gold_pairs = np.zeros((2, 2))
        np.add.at(gold_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        for step in range(1, rounds + 1):
            e = np.zeros((n * longest, 2))
            for k in range(2):
                e[:, k] = np.bincount(rows, weights[cols, k], n * longest)
            e = np.where(live[:, :, None], e.reshape(n, longest, 2), 0)
            fore, rear = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            fore[:, 0] = e[:, 0]
            for t in range(1, longest):
                new = np.logaddexp(fore[:, t - 1, 0, None] + pairs[0], fore[:, t - 1, 1, None] + pairs[1]) + e[:, t]
                fore[:, t] = np.where(live[:, t, None], new, fore[:, t - 1])
            for t in range(longest - 2, -1, -1):
                ahead = e[:, t + 1] + rear[:, t + 1]
                new = np.stack([np.logaddexp(ahead[:, 0] + pairs[k, 0], ahead[:, 1] + pairs[k, 1]) for k in range(2)], 1)
                rear[:, t] = np.where(live[:, t + 1, None], new, 0)
            total = np.logaddexp(fore[:, -1, 0], fore[:, -1, 1])
            chance = np.exp(fore + rear - total[:, None, None]) * live[:, :, None]
            joint = np.exp(fore[:, :-1, :, None] + pairs + (e + rear)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
            lack = (flat_gold - chance.reshape(-1, 2))
            slope = np.stack([np.bincount(cols, lack[rows, k], len(names)) for k in range(2)], 1) / n - l2 * weights
            slope_pairs = (gold_pairs - joint.sum((0, 1))) / n - l2 * pairs
            for value, g, (m, v) in ((weights, slope, moments[0]), (pairs, slope_pairs, moments[1])):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                value += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return ChainField(names, weights, pairs)


def labelled_pages(count: int = 400, seed: int = 4) -> list[str]:
    """Pages whose article blocks carry the attribute data-keep; made from layouts that vary by chance."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(1, 9))) for _ in range(600)]

    def say(low: int, high: int) -> str:
        text = " ".join(rng.choice(words) for _ in range(rng.randint(low, high))).capitalize()
        return text + rng.choice([".", ".", ".", "", "!", "?"])

    def links(k: int) -> str:
        return "".join(f"<li><a href='/x'>{say(1, 3)}</a></li>" for _ in range(k))

    def keep(tag: str, low: int, high: int) -> str:
        return f"<{tag} data-keep>{'<b>' * rng.randint(0, 1)}{say(low, high)}{rng.choice(['', f'</{tag}>'])}"

    def article() -> str:
        body = [keep("h1", 2, 12)] * (rng.random() < 0.8)
        for _ in range(rng.randint(1, 14)):
            body.append(rng.choice([keep("p", 1, 4), keep("p", 5, 120), keep("p", 5, 120), keep("h2", 1, 8), "<ul>" + keep("li", 1, 20) + keep("li", 1, 20) + "</ul>", "<blockquote>" + keep("p", 4, 40) + "</blockquote>", keep("pre", 1, 20)]))
            if rng.random() < 0.1:
                body.append(rng.choice([f"<aside class=related><p>{say(3, 30)}</p></aside>", f"<div class='ad'>{say(1, 30)}</div>", f"<form><label>{say(1, 4)}</label><button>{say(1, 2)}</button></form>", f"<nav class=toc><ul>{links(3)}</ul></nav>"]))
        return "".join(body)

    def strange() -> str:
        return "".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))

    def boiler() -> str:
        return rng.choice([
            f"<nav><ul>{links(rng.randint(1, 8))}</ul></nav>", f"<header class=site><a href='/'>{say(1, 4)}</a><p>{say(2, 20)}</p></header>", f"<aside><h3>{say(1, 4)}</h3><p>{say(3, 60)}</p></aside>",
            f"<div class='ad banner'>{say(2, 40)}</div>", f"<div class='ad'>{say(2, 40)}</div>", f"<div class='cookie notice'><p>{say(4, 40)}</p><button>{say(1, 2)}</button></div>", f"<div id='sidebar'><p>{say(3, 40)}</p></div>", f"<form><label>{say(1, 3)}</label></form>",
            f"<div class='{strange()}'><p>{say(2, 40)}</p></div>", f"<section id='{strange()}'><h2>{say(1, 4)}</h2><p>{say(2, 60)}</p></section>", f"<div class='{strange()}'>{say(2, 30)}</div>",
        ])

    def comments() -> str:
        name = rng.choice(["comments", "comments", strange()])
        return f"<{(t := rng.choice(['section', 'div']))} {rng.choice(['class', 'id'])}='{name}'><h2>{say(1, 3)}</h2>" + "".join(f"<div class='{rng.choice(['comment', strange()])}'><p>{say(2, 80)}</p></div>" for _ in range(rng.randint(1, 5))) + f"</{t}>"

    out = []
    for _ in range(count):
        shape = rng.random()
        head, tail = "".join(boiler() for _ in range(rng.randint(0, 4))), "".join(boiler() for _ in range(rng.randint(0, 3)))
        core = article()
        inside = comments() if rng.random() < 0.35 else ""
        if shape < 0.6:
            named = inside if "comment" in inside else ""
            core = f"<article>{core}{named}</article>{'' if named else inside}"
        elif shape < 0.75:
            core = f"<main><article>{core}</article>{inside}</main>"
        elif shape < 0.85:
            core = f"<main>{core}</main>{inside}"
        else:
            core = f"<div class='{rng.choice(['content', 'post', 'entry', 'story', 'article body', strange()])}'>{core}</div>{inside}"
        foot = f"<footer>&copy; {say(1, 6)} &middot; {say(2, 20)}</footer>" if rng.random() < 0.9 else ""
        out.append(f"<html><head><title>{say(2, 8)}</title></head><body>{head}{core}{tail}{foot}</body></html>")
    return out


def training_example(page: str) -> tuple[list[list[str]], list[int]]:
    """Features and labels; the attribute itself is no feature."""
    marked = re.sub(r"(<\w+) data-keep>", r"\1 class=zzkeep>", page)
    blocks = leaf_blocks(marked)
    labels = [int(".zzkeep" in b.names) for b in blocks]
    return block_features([b._replace(names=b.names - {".zzkeep"}) for b in blocks]), labels


@functools.lru_cache(maxsize=1)
def trained() -> ChainField:
    return ChainField.train([training_example(p) for p in labelled_pages()])


def main_text(page: str | None, model: ChainField) -> str:
    blocks = leaf_blocks(page or "", model.known)
    return "\n\n".join(b.text for b, keep in zip(blocks, model.viterbi(block_features(blocks))) if keep)


def _extractor(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            texts = [main_text(p, model) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: ChainField | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of each row."""
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(_extractor(shared), "page_id long, url string, text string, n_chars long")
