"""Main text of web pages by a recurrent block labeller (operator 5).

A page becomes a sequence of leaf blocks (text between block-level tags), each with its tag
path (tags, classes, ids, roles), its hashed words and a few measures. A bidirectional LSTM
reads the whole sequence, so that every block is labelled knowing what stands before and after
it; blocks labelled as main text are joined. The LSTM is written and trained in numpy.
"""

from __future__ import annotations

import html
import random
import re
import uuid
import warnings
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratlab.llm.common import thin_by_hash, worker_cache

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\s+|/|[^\s\"'=<>/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]*))?)*+)\s*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
#: Fixed values of the HTML standard: elements without content, with raw text, and block-level ones.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select", "canvas", "xmp", "noembed", "noframes"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
         "html", "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
         "th", "thead", "tr", "ul"}
CLOSES_P = BLOCK - {"body", "html", "head", "button", "label", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}, "option": {"select", "datalist"}}
HEAD_PARTS = {"head", "title", "meta", "link", "script", "style", "base", "basefont", "bgsound", "noscript", "noframes", "template"}
FOREIGN = {"svg", "math"}
#: Nesting up to which elements are described by their classes; deeper ones by their tag, and the path has the last eight of these.
NAMED_DEPTH = 500
P_SCOPE = {"td", "th", "button", "caption", "object"}


def names_of(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and the words of its class, id and role."""
    out = [tag]
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        out += [f".{w}" for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()) if w]
    return tuple(out)


def leaf_blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(tag path, text, share of the text inside links) of each leaf block with text, in order.

    Raw elements, comments and the head give no text. Open paragraphs and list items end as the standard has it; unknown
    end tags are passed over; a tag cut off by the end of the page gives no text.
    """
    out, stack, parts = [], [], []  # stack: (tag, names)
    open_: Counter[str] = Counter()  # how many elements of each tag are on the stack
    linked = total = 0

    def flush():
        nonlocal linked, total
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((tuple(n for _, names in stack[:NAMED_DEPTH] for n in names) + tuple(t for t, _ in stack[NAMED_DEPTH:][-8:]),
                        text, linked / max(1, total)))
        parts.clear()
        linked = total = 0

    def drop(k: int):
        for t, _ in stack[k:]:
            open_[t] -= 1
        del stack[k:]

    def pop_to(k: int):
        flush()
        drop(k)

    def end_head():
        pop_to(next(k for k, (t, _) in enumerate(stack) if t == "head"))

    def say(text: str):
        nonlocal linked, total
        if not text:
            return
        if open_["head"]:
            if not text.strip():
                return
            end_head()  # text ends the head
        parts.append(text)
        n = len(text.strip())
        total += n
        if open_["a"]:
            linked += n

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "br":
                parts.append(" ")
            if not open_[tag]:
                continue
            k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag)
            if tag in BLOCK:
                pop_to(k)
            elif not any(t in BLOCK for t, _ in stack[k:]):  # an inline end tag does not end the block around it
                drop(k)
            continue
        if open_["head"] and tag not in HEAD_PARTS:
            end_head()
        if tag in RAW:
            # the standard passes over the slash of an empty element, but for foreign ones
            if not (tag in FOREIGN and (m[3] or m[6] or "").rstrip().endswith("/")):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            if tag not in FOREIGN:
                parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                parts.append(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and open_["p"]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        pop_to(k)
                        break
                    if stack[k][0] in P_SCOPE:
                        break
            if tag in SAME and any(open_[t] for t in SAME[tag]):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in SCOPE[tag]:
                        break
                    if stack[k][0] in SAME[tag]:
                        pop_to(k)
                        break
        stack.append((tag, names_of(tag, m[3] or m[6] or "") if len(stack) < NAMED_DEPTH else (tag,)))
        open_[tag] += 1
    flush()
    return out


PATH_BUCKETS, WORD_BUCKETS = 1 << 12, 1 << 12
PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 16, 8, 5, 16


def bucket(word: str, n: int) -> int:
    return zlib.crc32(word.encode("utf-8")) % n


def features(blocks, buckets: dict[str, int]) -> tuple[list[list[int]], list[list[int]], list[list[float]]]:
    """Hashed path parts, hashed words and measures of the blocks of a page."""
    paths, words, measures = [], [], []
    for i, (path, text, link) in enumerate(blocks):
        last = [n for n in path if n[0] != "."][-3:]
        paths.append([bucket(n, PATH_BUCKETS) for n in (*path, "leaf>" + "/".join(last))])
        own = text.split()
        for w in set(own).difference(buckets):
            buckets[w] = bucket(w.lower(), WORD_BUCKETS)
        words.append([buckets[w] for w in own])
        measures.append([link, min(1.0, np.log1p(len(own)) / 6), float(text[-1] in ".!?…:\"'»”"), i / max(1, len(blocks) - 1),
                         min(1.0, text.count(",") / max(1, len(own)) * 5)])
    return paths, words, measures


class Labeller:
    """A bidirectional LSTM over blocks; ``parameters`` is a dict of arrays."""

    NAMES = ("path", "word", "wf", "uf", "bf", "wb", "ub", "bb", "out", "bias")

    def __init__(self, parameters: dict[str, np.ndarray] | None = None, seed: int = 11):
        r = np.random.default_rng(seed)
        n = PATH_DIM + WORD_DIM + MEASURES
        forget = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.p = parameters or {
            "path": r.normal(0, 0.3, (PATH_BUCKETS, PATH_DIM)), "word": r.normal(0, 0.1, (WORD_BUCKETS, WORD_DIM)),
            "wf": r.normal(0, 0.3, (n, 4 * HIDDEN)), "uf": r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), "bf": forget.copy(),
            "wb": r.normal(0, 0.3, (n, 4 * HIDDEN)), "ub": r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), "bb": forget.copy(),
            "out": r.normal(0, 0.3, (2 * HIDDEN, 1)), "bias": np.zeros(1)}

    def inputs(self, pages) -> tuple[np.ndarray, np.ndarray, tuple]:
        """(page, block, feature) padded, its mask, and what the gradient needs."""
        longest = max(len(p[2]) for p in pages)
        x = np.zeros((len(pages), longest, PATH_DIM + WORD_DIM + MEASURES))
        mask = np.zeros((len(pages), longest), dtype=bool)
        rows, flat_p, size_p, flat_w, size_w = [], [], [], [], []
        for k, (paths, words, measures) in enumerate(pages):
            mask[k, :len(measures)] = True
            x[k, :len(measures), PATH_DIM + WORD_DIM:] = measures
            for i, (ps, ws) in enumerate(zip(paths, words)):
                rows.append(k * longest + i)
                flat_p += ps
                size_p.append(len(ps))
                flat_w += ws
                size_w.append(len(ws))
        rows = np.array(rows)
        kept = []
        for flat, size, table, lo, hi in ((flat_p, size_p, "path", 0, PATH_DIM), (flat_w, size_w, "word", PATH_DIM, PATH_DIM + WORD_DIM)):
            flat, size = np.array(flat, dtype=np.int64), np.array(size)
            means = np.add.reduceat(self.p[table][flat], np.concatenate([[0], np.cumsum(size)[:-1]]), axis=0) / size[:, None]
            x.reshape(-1, x.shape[2])[rows, lo:hi] = means
            kept.append((flat, size, table, lo, hi))
        return x, mask, (rows, kept)

    @staticmethod
    def sigmoid(v):
        return 1 / (1 + np.exp(-np.clip(v, -30, 30)))

    def direction(self, x, mask, w, u, b, backward, keep):
        """Hidden states of one direction; with ``keep`` also what its gradient needs."""
        n, length, _ = x.shape
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        z0 = x @ self.p[w] + self.p[b]
        states, tape = np.zeros((n, length, HIDDEN)), []
        for t in (range(length - 1, -1, -1) if backward else range(length)):
            z = z0[:, t] + h @ self.p[u]
            gates = self.sigmoid(z[:, :3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            c_new = np.where(m, f * c + i * g, c)
            tanh = np.tanh(c_new)
            h_new = np.where(m, o * tanh, h)
            if keep:
                tape.append((t, h, c, i, f, o, g, tanh))
            h, c = h_new, c_new
            states[:, t] = h
        return states, tape

    def back(self, x, mask, d_states, tape, w, u, b, grads):
        n = len(x)
        dh, dc, dx = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.zeros_like(x)
        for t, h, c, i, f, o, g, tanh in reversed(tape):
            m = mask[:, t, None]
            dh = dh + d_states[:, t]
            own = np.where(m, dh, 0)
            d_c = np.where(m, dc, 0) + own * o * (1 - tanh * tanh)
            dz = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f), own * tanh * o * (1 - o), d_c * i * (1 - g * g)], axis=1)
            grads[w] += x[:, t].T @ dz
            grads[u] += h.T @ dz
            grads[b] += dz.sum(axis=0)
            dx[:, t] = dz @ self.p[w].T
            dh = np.where(m, 0, dh) + dz @ self.p[u].T
            dc = np.where(m, d_c * f, dc)
        return dx

    def logits(self, x, mask, keep=False):
        sf, tf = self.direction(x, mask, "wf", "uf", "bf", False, keep)
        sb, tb = self.direction(x, mask, "wb", "ub", "bb", True, keep)
        both = np.concatenate([sf, sb], axis=2)
        return (both @ self.p["out"])[:, :, 0] + self.p["bias"], both, tf, tb

    def gradient(self, pages, labels) -> dict[str, np.ndarray]:
        x, mask, (rows, kept) = self.inputs(pages)
        z, both, tf, tb = self.logits(x, mask, keep=True)
        y = np.zeros(mask.shape)
        for k, row in enumerate(labels):
            y[k, :len(row)] = row
        dz = np.where(mask, self.sigmoid(z) - y, 0)[:, :, None] / mask.sum()
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["out"] = np.einsum("abh,abo->ho", both, dz)
        grads["bias"] = dz.sum(axis=(0, 1))
        d_both = dz @ self.p["out"].T
        dx = self.back(x, mask, d_both[:, :, :HIDDEN], tf, "wf", "uf", "bf", grads) \
            + self.back(x, mask, d_both[:, :, HIDDEN:], tb, "wb", "ub", "bb", grads)
        flat_dx = dx.reshape(-1, dx.shape[2])[rows]
        for flat, size, table, lo, hi in kept:
            np.add.at(grads[table], flat, np.repeat(flat_dx[:, lo:hi] / size[:, None], size, axis=0))
        return grads

    def main_blocks(self, pages) -> list[np.ndarray]:
        x, mask, _ = self.inputs(pages)
        z, *_ = self.logits(x, mask)
        return [z[k, :len(p[2])] > 0 for k, p in enumerate(pages)]


def fit(pages, labels, epochs: int = 8, batch: int = 48, rate: float = 0.01, seed: int = 5) -> dict[str, np.ndarray]:
    """Adam on batches of pages of similar length."""
    model, rng = Labeller(), random.Random(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    step = 0
    order = sorted(range(len(pages)), key=lambda k: len(labels[k]))
    groups = [order[k:k + batch] for k in range(0, len(order), batch)]
    for _ in range(epochs):
        rng.shuffle(groups)
        for g in groups:
            step += 1
            grads = model.gradient([pages[k] for k in g], [labels[k] for k in g])
            for name, d in grads.items():
                m, v = moments[name]
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                model.p[name] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model.p


#: Bounds of the training sample: pages, and code points of one.
MAX_TRAIN_PAGES = 300
MAX_TRAIN_CHARS = 20_000
#: Words of tags, classes and ids that mark what is not main text, where a page says so itself.
NOT_MAIN = {"nav", "header", "footer", "aside", "form", "button", "label", "option", "menu", "dialog", ".nav", ".navbar", ".menu", ".ad", ".ads", ".advert",
            ".sidebar", ".footer", ".header", ".cookie", ".notice", ".banner", ".comments", ".comment", ".promo", ".related", ".share", ".social", ".breadcrumb"}


def says_main(path: tuple[str, ...]) -> bool | None:
    """What the markup itself says of a block: inside an article or main element or not; None if it does not say."""
    if any(n in NOT_MAIN for n in path):
        return False
    return True if any(n in ("article", "main", ".article", ".content", ".post") for n in path) else None


def compose(texts: list[str], other: list[str], rng: random.Random) -> str:
    """A page made of paragraphs ``texts`` and text of other pages around them, in one of many
    common layouts; the main text stands between the characters 0 and 1. What is around them varies by itself, so that
    labels depend on markup and place, not on the words."""
    pick = lambda n: " ".join(rng.choice(other).split()[:n])
    mark = lambda *names: rng.choice(names)
    links = lambda n: "".join(f'<li><a href="/{k}">{pick(rng.randint(1, 3))}</a></li>' for k in range(n))
    paragraphs = lambda n: "".join(f"<p>{pick(rng.randint(5, 60))}</p>" for _ in range(n))

    def tagged(inner: str, *kinds: str) -> str:
        tag, _, name = rng.choice(kinds).partition(".")
        attribute = f' {mark("class", "class", "id")}="{name}"' if name else ""
        return f"<{tag}{attribute}>{inner}</{tag}>"

    nav = lambda: tagged(f"<ul>{links(rng.randint(2, 8))}</ul>", "nav", "nav.menu", "div.navbar", "div.main-menu", "div.nav", "div.breadcrumb", "ul.menu")
    ad = lambda: tagged(rng.choice([pick(rng.randint(3, 30)), paragraphs(1), f'<a href="#">{pick(6)}</a>']),
                        "div.ad", "div.ads", "div.advert", "div.sponsored", "div.promo", "aside.ad", "section.advertisement", "div.ad-banner")
    notice = lambda: tagged(rng.choice([pick(rng.randint(4, 30)), paragraphs(1)]) + rng.choice(["", "<button>ok</button>"]),
                            "div.cookie-notice", "div.notice", "div.alert", "div.cookie-banner", "div.consent", "div.banner", "div.gdpr", "section.newsletter")
    side = lambda: tagged(rng.choice([f"<h3>{pick(3)}</h3><ul>{links(rng.randint(2, 6))}</ul>", paragraphs(rng.randint(1, 3)), pick(rng.randint(5, 40))]),
                          "aside", "aside.sidebar", "div.sidebar", "div.related", "div.widget", "section.related-posts", "div.recommended")
    form = lambda: tagged(f"<label>{pick(2)}</label><input type=text><button>{pick(1)}</button>" + rng.choice(["", f"<p>{pick(8)}</p>"]),
                          "form", "form.search", "form.login", "div.subscribe")
    comment = lambda: tagged(f"<h4>{pick(2)}</h4>" + paragraphs(rng.randint(1, 2)), "div.comment", "li.comment", "article.comment", "div.reply")
    comments = lambda: tagged(rng.choice(["", f"<h3>{pick(2)}</h3>"]) + "".join(comment() for _ in range(rng.randint(1, 4))),
                              "section.comments", "div.comments", "div.comment-list", "ol.commentlist", "div.discussion", "div.responses")
    head = lambda: tagged(rng.choice([f"<h1>{pick(3)}</h1>", f'<a href="/">{pick(2)}</a>', f"<p>{pick(6)}</p>", f"<div>{pick(4)}</div>"]) + rng.choice(["", nav()]),
                          "header", "header.site-header", "div.header", "div.masthead", "div.topbar")
    foot = lambda: tagged(rng.choice([f"&copy; {pick(3)} &middot; {pick(rng.randint(2, 20))}", paragraphs(1), f"<ul>{links(3)}</ul>"]),
                          "footer", "footer.site-footer", "div.footer", "div.copyright", "div.bottom")
    main = []
    for k, text in enumerate(texts):
        text = html.escape(text)
        if rng.random() < 0.25:
            cut = rng.randint(0, len(text))
            text = rng.choice([f"<b>{text}</b>", f"<b>{text}<br>", f'{text} <a href="/x">{html.escape(pick(2))}</a>', f"{text[:cut]}<i></i>{text[cut:]}"])
        if k == 0 and rng.random() < 0.7:
            main.append(f"<h1>{text}</h1>")
        else:
            kind = rng.random()
            main.append(f"<p>{text}" + ("</p>" if rng.random() < 0.85 else "") if kind < 0.75 else f"<h2>{text}</h2>" if kind < 0.8
                        else f"<ul><li>{text}</li></ul>" if kind < 0.87 else f"<blockquote>{text}</blockquote>" if kind < 0.93 else f"<div>{text}</div>")
    body = "".join(b + (rng.choice([ad, side, notice])() if rng.random() < 0.06 else "") for b in main)
    wrapped = tagged(body, "article", "article", "main", "div.content", "div.post", "div.entry-content", "div.article-body", "section.story", "div.main", "article.post")
    if rng.random() < 0.3:
        wrapped = tagged(wrapped, "main", "div.container", "div.wrapper", "section")
    before = [f() for f in (notice, head, nav, ad, side, form) if rng.random() < 0.5]
    after = [f() for f in (comments, side, ad, form, nav, notice) if rng.random() < 0.4]
    rng.shuffle(before)
    rng.shuffle(after)
    page = "".join(before) + "\x00" + wrapped + "\x01" + "".join(after) + (foot() if rng.random() < 0.85 else "")
    return f"<html><head><title>{pick(5)}</title></head><body>{page}</body></html>"


def training_pages(pages: list[str], seed: int = 3, variants: int = 3):
    """Features and labels: the pages themselves where their markup says which blocks are main text, and
    pages composed of their texts."""
    rng, buckets = random.Random(seed), {}
    xs, ys, mains, rest, unsaid = [], [], [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        said = [says_main(b[0]) for b in blocks]
        mains.append([b[1] for b, s in zip(blocks, said) if s])
        rest += [b[1] for b, s in zip(blocks, said) if s is False]
        unsaid.append((blocks, said))
        if blocks and None not in said and any(said):
            xs.append(features(blocks, buckets))
            ys.append([float(s) for s in said])
    if not any(mains):
        # no page says which blocks are its main text: running text, as far as there is some
        texts = [[b[1] for b, s in zip(blocks, said) if s is not False and b[1].split()] for blocks, said in unsaid]
        mains = [[t for t in page if len(t.split()) >= 8] for page in texts]
        mains = mains if any(mains) else texts
    other = [t for t in rest + [t for m in mains for t in m] if t.split()]
    for texts in [m for m in mains if m] if other else []:
        for _ in range(variants):
            page = compose(texts[:rng.randint(1, 12)], other, rng)
            top, _, tail = page.partition("\x00")
            wrapped, _, end = tail.partition("\x01")
            blocks = leaf_blocks(top + wrapped + end)
            lead, upto = len(leaf_blocks(top)), len(leaf_blocks(top + wrapped))
            label = [float(lead <= k < upto and not any(n in NOISE for n in b[0])) for k, b in enumerate(blocks)]
            if blocks:
                xs.append(features(blocks, buckets))
                ys.append(label)
    return xs, ys


#: Marks of what ``compose`` puts between the paragraphs of a main text.
NOISE = {".ad", ".ads", ".advert", ".sponsored", ".promo", ".advertisement", "aside", ".sidebar", ".related", ".widget", ".recommended",
         ".cookie", ".notice", ".alert", ".consent", ".banner", ".gdpr", ".newsletter", "button", ".posts"}


def extract_main_text(pages: DataFrame, max_train_pages: int = MAX_TRAIN_PAGES) -> DataFrame:
    """Main text of every page; one row per input row: page_id, url, text, n_chars.

    The labeller is trained on at most ``max_train_pages`` pages of at most 20,000 code points, where these are fewer also on the first 20,000
    code points of longer ones, chosen by a hash of id and html, with the labels that their own markup gives and as pages composed anew of their texts; then it labels every block of every whole page. Null html: empty text. A
    page without main blocks: empty text. Null page_id or url: kept null. Repeated rows: one row each. Other
    columns are not read. Where no page of the sample marks its main text, its blocks of
    eight words or more outside marked side matter stand for it. Without any text in the sample every text is empty, with a warning. Nothing but the sample is gathered; the model (about 110,000 numbers) is sent to the executors.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    filled = rows.where(F.length("html") > 0).select(F.substring("html", 1, MAX_TRAIN_CHARS).alias("html"), F.xxhash64("page_id", "html").alias("h"),
                                                     (F.length("html") <= MAX_TRAIN_CHARS).alias("whole"))
    n = {r["whole"]: r["n"] for r in filled.groupBy("whole").agg(F.count("*").alias("n")).collect()}
    sample = []
    for whole in (True, False):
        if (wanted := max_train_pages - len(sample)) > 0 and n.get(whole):
            sample += thin_by_hash(filled.where(F.col("whole") == whole), "h", n[whole], wanted) \
                .groupBy("h").agg(F.min("html").alias("html")).orderBy("h").limit(wanted).collect()
    xs, ys = training_pages([r["html"] for r in sample])
    if not xs and sample:
        warnings.warn("no page sampled for training has any text: every text is empty")
    model = spark.sparkContext.broadcast({k: v.astype(np.float32) for k, v in fit(xs, ys).items()}) if xs else None
    key = f"labeller:{uuid.uuid4().hex}"

    def run(batches):
        labeller = worker_cache(key, "labeller", lambda: Labeller(model.value)) if model else None
        buckets = worker_cache(key, "words", dict)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                blocks = [leaf_blocks(h or "") for h in part.column(2).to_pylist()]
                if len(buckets) > 400_000:
                    buckets.clear()
                texts = [""] * len(blocks)
                order = sorted((k for k in range(len(blocks)) if blocks[k]), key=lambda k: len(blocks[k]))
                group, size = [], 0
                for j, k in enumerate(order if labeller else []):
                    group.append(k)
                    size += len(blocks[k])
                    if len(group) >= 128 or size >= 4_000 or j == len(order) - 1:
                        for g, keep in zip(group, labeller.main_blocks([features(blocks[g], buckets) for g in group])):
                            texts[g] = "\n\n".join(b[1] for b, main in zip(blocks[g], keep) if main)
                        group, size = [], 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, SCHEMA)
