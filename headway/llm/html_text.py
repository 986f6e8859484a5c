"""Main text of web pages by a recurrent block labeller, in numpy.

A page becomes the sequence of its leaf blocks. Each is described by a hashed vector of the tags and names it stands
in, another of its words, and a few measures. A bidirectional LSTM reads the whole sequence, and every block is
judged with what comes before and after it on the page. The model is trained on a bounded sample of pages: as they are,
with blocks inside their article element as text, and taken apart and put together in other layouts.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH, WORDS, MEASURES = 128, 64, 6
FEATURES = PATH + WORDS + MEASURES
INPUT, HIDDEN = 32, 20
#: The sample to learn from: pages, the longest html of one, and layouts made of each.
SAMPLE_PAGES = 240
SAMPLE_CHARS = 20_000
LAYOUTS = 3
EPOCHS = 6
#: Words of a block that counts as text where no page has an article element.
LONG_BLOCK = 8
#: Pages labelled at once, and the most steps over all of them, padding included; a longer page is labelled alone.
PAGES_AT_ONCE = 64
STEPS_AT_ONCE = 32_768
#: Characters of html read at once; a longer page is read alone.
CHARS_AT_ONCE = 4_000_000

_MARK = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME_END = re.compile(r"[^\s/>]*")
_ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
_SPECIAL = re.compile(r"""[>"']""")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE_END = re.compile(r"[.!?](?:\s|$)")

#: Elements whose content is no text of the page, fixed by HTML.
UNSEEN = frozenset("script style title template noscript iframe svg math object canvas audio video head".split())
#: Elements within a line of text, fixed by HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter output q ruby rp rt s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What ends when an element of the same set begins.
SIBLINGS = tuple(frozenset(x.split()) for x in ("li", "dt dd", "tr", "td th", "option", "thead tbody tfoot"))
#: What such an end doesn't reach beyond.
LISTS = frozenset("ul ol dl table select".split())


def _slot(name: str, size: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % size


def _named(attributes: str) -> list[str]:
    names = []
    for value in _NAMED.findall(attributes):
        for word in _NAME.findall(value):
            names += [f".{word.lower()}", f"~{word.lower()[:4]}"]
    return names


class _Memo(dict):
    def __init__(self, make, most: int = 100_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


_PATH_SLOTS = _Memo(lambda key: [_slot(x, PATH) for x in (key[0], *_named(key[1]))])
_WORD_SLOTS = _Memo(lambda word: _slot(word, WORDS))


class _Tags:
    """Reads the tags of a page from left to right, in time linear in its length."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.specials: list[int] | None = None
        self.ends: list[int] = []

    def _learn_ends(self) -> None:
        """For each `>` or quote, where a tag ends that reads it outside quotes; -1 if a quote stays open."""
        self.specials = [m.start() for m in _SPECIAL.finditer(self.page)]
        self.ends = [-1] * len(self.specials)
        following: dict[str, int] = {}
        for k in range(len(self.specials) - 1, -1, -1):
            char = self.page[self.specials[k]]
            if char == ">":
                self.ends[k] = self.specials[k]
            else:
                close = following.get(char, len(self.specials))
                self.ends[k] = self.ends[close + 1] if close + 1 < len(self.specials) else -1
                following[char] = k

    def _end(self, at: int) -> int:
        """The `>` that ends a tag whose attributes begin at `at`: outside quotes, else the next one at all."""
        if self.specials is None:
            end = _ATTRIBUTES.match(self.page, at).end()
            if end < len(self.page) and self.page[end] == ">":
                return end
            self._learn_ends()  # a second vain walk could be as long as the first
        k = bisect_left(self.specials, at)
        end = self.ends[k] if k < len(self.specials) else -1
        return end if end >= 0 else self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Begin, end, whether it is an end tag, name and attributes of the next tag; comments and the like have no name."""
        page = self.page
        while found := _MARK.search(page, at):
            begin, mark = found.start(), found[0]
            if mark == "<!--":
                end = page.find("-->", begin + 4)
                return begin, end + 3 if end >= 0 else len(page), False, "", ""
            if mark in ("<!", "<?"):
                end = page.find(">", begin + 2)
                return begin, end + 1 if end >= 0 else len(page), False, "", ""
            if begin < self.last:
                name_at = found.end() - 1
                name_end = _NAME_END.match(page, name_at).end()
                end = self._end(name_end)
                return begin, end + 1, mark[1] == "/", page[name_at:name_end], page[name_end:end]
            at = found.end()  # nothing closes it: text
        return None


@dataclass
class Blocks:
    """The leaf blocks of a page, in order: text, path vector, and characters within links."""

    texts: list[str] = field(default_factory=list)
    paths: list[np.ndarray] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def blocks_of(page: str) -> Blocks:
    """Reads a page as browsers do where it matters: unclosed and crossing elements, omitted end tags, raw text."""
    out = Blocks()
    stack: list[tuple[str, np.ndarray]] = [("", np.zeros(PATH, bool))]
    places: defaultdict[str, list[int]] = defaultdict(list)  # where in the stack a name is, so that nothing scans it
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0

    def end_block() -> None:
        nonlocal linked
        if parts:
            if text := " ".join("".join(parts).split()):
                out.texts.append(text)
                out.paths.append(stack[-1][1])
                out.linked.append(linked)
            parts.clear()
        linked = 0

    def cut(k: int) -> None:
        for name, _ in stack[k:]:
            places[name].pop()
        del stack[k:]

    def innermost(names: frozenset[str]) -> int:
        return max((places[x][-1] for x in names if places[x]), default=0)

    def close(names: frozenset[str], beyond: frozenset[str] = frozenset()) -> None:
        k = innermost(names)
        if k > innermost(beyond):
            end_block()
            cut(k)

    tags, headless = _Tags(page), False
    n = len(page)
    while at < n:
        found = tags.next(at)
        chunk = page[at : found[0] if found else n]
        if chunk:
            chunk = html.unescape(chunk) if "&" in chunk else chunk
            parts.append(chunk)
            linked += len(chunk) if in_link else 0
        if not found:
            break
        _, at, ends, name, attributes = found
        if not name:
            continue
        name = name.lower()
        if name in UNSEEN and not ends:
            if attributes.endswith("/") and name not in ("script", "style", "title"):
                continue
            if name == "head" and headless:
                continue
            over = re.compile(rf"</{re.escape(name)}\s*>" + (r"|<body\b" if name == "head" else ""), re.IGNORECASE).search(page, at)
            headless = name == "head" and not over
            at = (over.start() if over[0][1] in "bB" else over.end()) if over else (at if headless else n)
            continue
        if name == "a":
            in_link = 0 if ends else 1
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            continue
        if ends:
            close(frozenset((name,)))
            if name == "p":
                end_block()
            continue
        end_block()
        for group in SIBLINGS:
            if name in group:
                close(group, LISTS)
        if stack[-1][0] == "p":
            cut(len(stack) - 1)
        if name not in VOID:
            path = stack[-1][1].copy()
            path[_PATH_SLOTS[name, attributes.strip()]] = True
            places[name].append(len(stack))
            stack.append((name, path))
    end_block()
    return out


def features(blocks: Blocks) -> np.ndarray:
    """A row for each block: its path, its words, and measures of text, links, sentences and place."""
    n = len(blocks.texts)
    out = np.zeros((n, FEATURES), np.float32)
    for i, (text, path, linked) in enumerate(zip(blocks.texts, blocks.paths, blocks.linked, strict=True)):
        row = out[i]
        row[:PATH] = path
        words = text.lower().split()
        slots = [_WORD_SLOTS[w] for w in set(words)]
        row[PATH : PATH + WORDS] = np.bincount(slots, minlength=WORDS) / len(slots)
        row[PATH + WORDS :] = (
            np.log1p(len(text)) / 8,
            np.log1p(len(words)) / 6,
            min(1.0, linked / len(text)),
            min(1.0, len(_SENTENCE_END.findall(text)) / 4),
            i / n,
            1.0 / (1 + i),
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Weights: w, b into the cells' input; x, h, c of either direction's gates (in, forget, out, new); o, d out."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.weights = {"w": normal(FEATURES, INPUT), "b": np.zeros(INPUT, np.float32)}
        for side in "fb":
            gates = np.zeros(4 * HIDDEN, np.float32)
            gates[HIDDEN : 2 * HIDDEN] = 1
            self.weights |= {f"x{side}": normal(INPUT, 4 * HIDDEN), f"h{side}": normal(HIDDEN, 4 * HIDDEN), f"c{side}": gates}
        self.weights |= {"o": normal(2 * HIDDEN), "d": np.zeros(1, np.float32)}

    def _run(self, side: str, inputs: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of one direction over (step, page, input)."""
        w = self.weights
        ahead = inputs @ w[f"x{side}"] + w[f"c{side}"]
        hidden = np.zeros((inputs.shape[1], HIDDEN), np.float32)
        cell = np.zeros_like(hidden)
        states = np.empty((*inputs.shape[:2], HIDDEN), np.float32)
        for t in range(len(inputs)):
            gates = ahead[t] + hidden @ w[f"h{side}"]
            gates[:, : 3 * HIDDEN] = _sigmoid(gates[:, : 3 * HIDDEN])
            gates[:, 3 * HIDDEN :] = np.tanh(gates[:, 3 * HIDDEN :])
            into, forget, out, new = np.split(gates, 4, axis=1)
            before, cell = cell, forget * cell + into * new
            if keep is not None:
                keep.append((hidden, before, cell, gates))
            hidden = out * np.tanh(cell)
            states[t] = hidden
        return states

    @staticmethod
    def _turned(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each page's steps from its last to its first; padding stays behind."""
        t = np.arange(len(steps))[:, None]
        return np.take_along_axis(steps, np.where(t < lengths, lengths - 1 - t, t)[:, :, None], axis=0)

    def _padded(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros((lengths.max(), len(lengths), flat.shape[1]), np.float32)
        ends = np.cumsum(lengths)
        for p, (end, n) in enumerate(zip(ends, lengths, strict=True)):
            out[:n, p] = flat[end - n : end]
        return out

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page the chance of each block to be main text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        filled = sorted((k for k, page in enumerate(pages) if len(page)), key=lambda k: len(pages[k]))
        w = self.weights
        sizes = [len(pages[k]) for k in filled]
        end = 0
        while (begin := end) < len(filled):
            end = begin + 1
            while end < min(len(filled), begin + PAGES_AT_ONCE) and sizes[end] * (end + 1 - begin) <= STEPS_AT_ONCE:
                end += 1
            part = filled[begin:end]
            lengths = np.array([len(pages[k]) for k in part])
            inputs = self._padded(np.tanh(np.concatenate([pages[k] for k in part]) @ w["w"] + w["b"]), lengths)
            forward = self._run("f", inputs)
            backward = self._turned(self._run("b", self._turned(inputs, lengths)), lengths)
            chance = _sigmoid(np.concatenate([forward, backward], axis=2) @ w["o"] + w["d"])
            for p, k in enumerate(part):
                out[k] = chance[: lengths[p], p]
        return out

    def gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        w = self.weights
        lengths = np.array([len(x) for x in pages])
        flat = np.concatenate(pages)
        hidden_in = np.tanh(flat @ w["w"] + w["b"])
        inputs = self._padded(hidden_in, lengths)
        keeps: dict[str, list] = {"f": [], "b": []}
        turned = self._turned(inputs, lengths)
        forward = self._run("f", inputs, keeps["f"])
        backward = self._turned(self._run("b", turned, keeps["b"]), lengths)
        both = np.concatenate([forward, backward], axis=2)
        wanted = self._padded(np.concatenate(labels)[:, None].astype(np.float32), lengths)[:, :, 0]
        real = np.arange(len(both))[:, None] < lengths
        wrong = np.where(real, _sigmoid(both @ w["o"] + w["d"]) - wanted, 0) / real.sum()
        grads = {"o": np.einsum("tp,tph->h", wrong, both), "d": np.array([wrong.sum()])}
        back = wrong[:, :, None] * w["o"]
        into = self._back("f", inputs, back[:, :, :HIDDEN], keeps["f"], grads)
        into = into + self._turned(self._back("b", turned, self._turned(back[:, :, HIDDEN:], lengths), keeps["b"], grads), lengths)
        rows = np.concatenate([into[:n, p] for p, n in enumerate(lengths)]) * (1 - hidden_in**2)
        grads["w"], grads["b"] = flat.T @ rows, rows.sum(axis=0)
        return grads

    def _back(self, side: str, inputs: np.ndarray, back: np.ndarray, keep: list, grads: dict) -> np.ndarray:
        """Through time; adds the direction's gradients and returns those of its inputs."""
        w = self.weights
        all_gates = np.empty((*inputs.shape[:2], 4 * HIDDEN), np.float32)
        to_hidden = np.zeros((inputs.shape[1], HIDDEN), np.float32)
        to_cell = np.zeros_like(to_hidden)
        recurrent = np.zeros_like(w[f"h{side}"])
        for t in range(len(inputs) - 1, -1, -1):
            hidden, before, cell, gates = keep[t]
            into, forget, out, new = np.split(gates, 4, axis=1)
            own, bent = back[t] + to_hidden, np.tanh(cell)
            to_cell = to_cell + own * out * (1 - bent**2)
            change = [to_cell * new * into * (1 - into), to_cell * before * forget * (1 - forget)]
            change += [own * bent * out * (1 - out), to_cell * into * (1 - new**2)]
            all_gates[t] = np.concatenate(change, axis=1)
            recurrent += hidden.T @ all_gates[t]
            to_hidden, to_cell = all_gates[t] @ w[f"h{side}"].T, to_cell * forget
        grads[f"h{side}"], grads[f"c{side}"] = recurrent, all_gates.sum(axis=(0, 1))
        grads[f"x{side}"] = np.einsum("tpi,tpg->ig", inputs, all_gates)
        return all_gates @ w[f"x{side}"].T


#: Layouts that training pages are put into. {t} is a text, {w} a word or two.
ARTICLES = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>',
    '<div id="content"><div class="post">{}</div></div>', '<div class="article-body">{}</div>', '<section class="entry-content">{}</section>',
    '<div itemprop="articleBody">{}</div>', '<div class="story">{}</div>', '<div id="main"><article class="post">{}</article></div>',
    "<div>{}</div>", "<article><div>{}</div></article>",
)
TEXTS = (
    "<p>{t}</p>", "<p>{t}</p>", "<p>{t}</p>", "<p>{t}", "<p><b>{t}<br>", "<h2>{t}</h2>", "<h3>{t}</h3>", "<ul><li>{t}</li></ul>",
    "<blockquote>{t}</blockquote>", "<div>{t}</div>", "<pre>{t}</pre>", "<figure><figcaption>{t}</figcaption></figure>",
    "<table><tr><td>{t}</td></tr></table>", "<ol><li><p>{t}</p></li></ol>", "<p><em>{t}</em></p>", "<section><p>{t}</p></section>",
)
BESIDE = (
    "<nav><ul><li><a href='/'>{w}</a></li><li><a href='/'>{w}</a></li><li><a href='/'>{w}</a></li></ul></nav>",
    "<header><h1>{w}</h1><p>{t}</p></header>", '<header class="site-header"><a href="/">{w}</a></header>', "<footer><p>{t}</p></footer>",
    "<footer>&copy; {t}</footer>", '<div class="footer">{t}</div>', '<div id="footer"><p>{t}</p></div>', "<aside><h3>{w}</h3><p>{t}</p></aside>",
    '<aside class="sidebar"><ul><li><a href="#">{w}</a></li></ul></aside>', '<div class="sidebar"><h4>{w}</h4><p>{t}</p></div>',
    '<div id="sidebar"><p>{t}</p></div>', '<div class="ad">{t}</div>', '<div class="ads"><p>{t}</p></div>', '<div class="advert"><a href="#">{t}</a></div>',
    '<div class="advertisement"><p>{t}</p></div>', '<div class="sponsored"><p>{t}</p></div>', '<div class="promo banner"><p>{t}</p></div>',
    '<div class="cookie-notice"><p>{t}</p><button>{w}</button></div>', '<div id="cookie-banner">{t}</div>', '<div class="notice">{t}</div>',
    '<div class="alert" role="alert"><p>{t}</p></div>', '<div class="consent"><p>{t}</p></div>', '<div class="popup modal"><p>{t}</p></div>',
    "<form><label>{w}</label><input name='q'><button>{w}</button></form>", '<form class="newsletter"><p>{t}</p><input><button>{w}</button></form>',
    '<form action="/search"><select><option>{w}</option><option>{w}</option></select><textarea>{t}</textarea></form>',
    '<div class="comments"><h3>{w}</h3><div class="comment"><p>{t}</p></div></div>', '<section id="comments"><article><p>{t}</p></article></section>',
    '<div class="comment"><span>{w}</span><p>{t}</p></div>', '<ol class="comment-list"><li class="comment"><p>{t}</p></li></ol>',
    '<section class="comments"><h2>{w}</h2><ul><li><b>{w}</b><p>{t}</p></li></ul></section>', '<div id="comments"><p>{t}</p></div>',
    '<ul class="menu"><li><a href="#">{w}</a></li><li><a href="#">{w}</a></li></ul>', '<div class="menu"><a href="#">{w}</a> <a href="#">{w}</a></div>',
    '<div class="breadcrumb"><a href="/">{w}</a> &gt; <a href="/">{w}</a></div>', '<div class="related"><h3>{w}</h3><p><a href="#">{t}</a></p></div>',
    '<div class="share social"><a href="#">{w}</a><a href="#">{w}</a></div>', '<div class="subscribe"><p>{t}</p></div>', '<div class="widget"><p>{t}</p></div>',
    '<div class="header"><p>{t}</p></div>', '<div id="header">{w}</div>', '<div class="nav"><a href="/">{w}</a></div>', '<div role="navigation"><p>{w}</p></div>',
    '<div role="banner"><p>{t}</p></div>', '<div role="complementary"><p>{t}</p></div>', '<div role="contentinfo">{t}</div>', '<p class="copyright">{t}</p>',
)


def sample_labels(blocks: Blocks) -> np.ndarray:
    """Of a page as it is: what stands in an article element, and in no part that HTML has for something else."""
    article = _slot("article", PATH)
    other = [_slot(x, PATH) for x in ("nav", "footer", "aside", "form")]
    return np.array([bool(path[article]) and not path[other].any() for path in blocks.paths], bool)


def laid_out(rng: random.Random, title: str, texts: list[str], strange: list[str]) -> tuple[str, dict[str, bool]]:
    """A page of another layout, and whether each block's text belongs to the article."""
    known: dict[str, bool] = {}

    def filled(template: str, text: str, is_text: bool) -> str:
        known[text] = is_text
        while "{w}" in template:
            few = " ".join(rng.choice(strange).split()[: rng.randint(1, 2)])
            known.setdefault(few, False)
            template = template.replace("{w}", html.escape(few), 1)
        return template.replace("{t}", html.escape(text))

    def beside() -> str:
        words = rng.choice(strange).split()
        begin = rng.randrange(len(words))
        return filled(rng.choice(BESIDE), " ".join(words[begin : begin + rng.randint(2, 60)]), False)

    inner = [filled(rng.choice(("<h1>{t}</h1>", "<header><h1>{t}</h1></header>", "<h1>{t}</h1>")), title, True)] if title else []
    usual = rng.choice((None, "<p>{t}</p>", "<p>{t}</p>"))
    for text in texts:
        inner.append(filled(usual if usual and rng.random() < 0.8 else rng.choice(TEXTS), text, True))
        if rng.random() < 0.08:
            inner.append("</p>" + beside())
    around = [beside() for _ in range(rng.randint(1, 5))], [beside() for _ in range(rng.randint(1, 5))]
    body = "".join(around[0]) + rng.choice(ARTICLES).format("".join(inner)) + "".join(around[1])
    return f"<html><head><title>{html.escape(title)}</title></head><body>{body}</body></html>", known


def train(pages: list[str], seed: int = 3, epochs: int = EPOCHS, layouts: int = LAYOUTS) -> BlockLabeller:
    """A labeller from html pages. If none has an article element, it learns from layouts made of their longer blocks
    alone; if none has a block, it takes every block for text."""
    rng, model = random.Random(seed), BlockLabeller(seed)
    examples: list[tuple[np.ndarray, np.ndarray]] = []
    read = [(blocks, sample_labels(blocks)) for blocks in map(blocks_of, pages) if blocks.texts]
    marked = [(blocks, labels) for blocks, labels in read if labels.any()]
    if not read:
        model.weights |= {"o": np.zeros_like(model.weights["o"]), "d": np.full(1, 5, np.float32)}
        return model
    if not marked:
        long = [np.array([len(text.split()) >= LONG_BLOCK for text in blocks.texts]) for blocks, _ in read]
        read = [(blocks, labels if labels.any() else ~labels) for (blocks, _), labels in zip(read, long, strict=True)]
    strange = [text for blocks, _ in marked or read for text in blocks.texts]
    for blocks, labels in marked or read:
        if marked:
            examples.append((features(blocks), labels))
        own = [text for text, is_text in zip(blocks.texts, labels, strict=True) if is_text]
        for _ in range(layouts):
            some = [x for x in own[1:] if rng.random() < 0.7] or own[1:]
            page, known = laid_out(rng, own[0], some, strange)
            made = blocks_of(page)
            if made.texts:
                examples.append((features(made), np.array([known.get(x, False) for x in made.texts])))
    means = {k: np.zeros_like(v) for k, v in model.weights.items()}
    squares = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step, total = 0, max(1, epochs * -(-len(examples) // 16))
    for _ in range(epochs):
        rng.shuffle(examples)
        for k in range(0, len(examples), 16):
            step += 1
            rate = 0.02 * (1 - 0.95 * step / total)
            part = examples[k : k + 16]
            for name, g in model.gradients([x for x, _ in part], [y for _, y in part]).items():
                g = np.clip(g, -1, 1)
                means[name] += 0.1 * (g - means[name])
                squares[name] += 0.01 * (g * g - squares[name])
                change = means[name] / (1 - 0.9**step) / (np.sqrt(squares[name] / (1 - 0.99**step)) + 1e-6)
                model.weights[name] -= (rate * change).astype(np.float32)
    return model


def main_texts(model: BlockLabeller, pages: list[str | None]) -> list[str]:
    """The main text of each page: its blocks between empty lines."""
    read = [blocks_of(page or "") for page in pages]
    chances = model.scores([features(blocks) for blocks in read])
    return [
        "\n\n".join(text for text, chance in zip(blocks.texts, scores, strict=True) if chance > 0.5)
        for blocks, scores in zip(read, chances, strict=True)
    ]


def learn(pages: DataFrame, sample: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> BlockLabeller:
    """A labeller from about `sample` pages of at most `chars` characters, or twice the shortest page where all are
    longer, chosen by a hash of page_id; they are all that comes to the driver."""
    named = pages.where((F.length("html") > 0) & F.col("page_id").isNotNull()).select("page_id", "html")
    least = named.agg(F.min(F.length("html"))).first()[0] or 0
    fit = named.where(F.length("html") <= max(chars, 2 * least))
    count = fit.count()
    chance = F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) / (1 << 20)
    rows = fit.where(chance < sample / max(count, 1)).collect()
    return train([r["html"] for r in sorted(rows, key=lambda r: (r["page_id"], r["html"]))])


def extract(pages: DataFrame, model: BlockLabeller | None = None) -> DataFrame:
    """For every row page_id, url, text (the main text of the whole html) and n_chars (its code points), by a labeller
    learnt from `pages` where none is given.

    Null or empty html, and pages without main text, give the empty text. Rows come back one for one, repeated ones
    too; other columns aren't read; an empty table gives an empty one. The order of a page's text is the page's.
    Time and memory are linear in a page, whatever its markup; a page over the bounds above is read and labelled alone.
    A `<` that no `>` follows is text. Where the sample has no article element, the labeller learns from made layouts.
    """
    model = model or learn(pages)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column("html")), 0).to_pylist()
            end = 0
            while (begin := end) < batch.num_rows:
                chars, end = sizes[begin], begin + 1
                while end < min(batch.num_rows, begin + 4 * PAGES_AT_ONCE) and (chars := chars + sizes[end]) <= CHARS_AT_ONCE:
                    end += 1
                part = batch.slice(begin, end - begin)
                texts = main_texts(model, part.column("html").to_pylist())
                arrays = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
                arrays.append(pa.array([len(x) for x in texts], pa.int64()))
                yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(label, schema)
