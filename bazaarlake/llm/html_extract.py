"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

Every block of a page is content or not. The field scores each block by its ancestors' tags and names and by the form of its
text, and each pair of neighbouring labels; its weights maximise the likelihood of labelled pages (penalised, by gradient
steps of fixed number, so always the same), and a page's labels are the most likely sequence (Viterbi). The labelled
pages are laid out by rule in ``labelled_pages``: articles in the usual containers among menus, headers, footers,
sidebars, notices, adverts, forms and comments. Training sees these few pages only and runs on the driver; the weights travel
with the task.

Defined results: null or empty html, or a page without content, gives the empty text; a page cut off in the middle is read
as far as it goes; repeated rows give one result each; null ids and urls are carried along; other columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.html_blocks import Block, blocks_of

STEPS = 250
RATE = 0.1
PENALTY = 0.05
PAGES = 240


@dataclass
class Field:
    weights: dict[str, tuple[float, float]]  # of a feature, for the labels "not content" and "content"
    change: np.ndarray  # of a label that follows another

    def labels(self, blocks: list[Block]) -> list[int]:
        """The most likely labels."""
        if not blocks:
            return []
        (a00, a01), (a10, a11) = self.change.tolist()
        best, back = None, []
        for block in blocks:
            zero = one = 0.0
            for f in block.features:
                if f in self.weights:
                    w = self.weights[f]
                    zero += w[0]
                    one += w[1]
            if best is None:
                best = (zero, one)
                continue
            from_zero = (best[0] + a00, best[1] + a10)
            from_one = (best[0] + a01, best[1] + a11)
            back.append((int(from_zero[1] > from_zero[0]), int(from_one[1] > from_one[0])))
            best = (max(from_zero) + zero, max(from_one) + one)
        label = int(best[1] > best[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def text(self, html: str | None) -> str:
        blocks = blocks_of(html or "")
        return " ".join(b.text for b, y in zip(blocks, self.labels(blocks), strict=True) if y)


def labelled_pages(n: int = PAGES, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Pages as html with the label of each of their blocks, laid out by rule."""
    rng = random.Random(seed)
    syllables = "an ba ce do en fi ga ho in ka lo mi no or pe ra si ta un ve wi yo".split()
    pick = rng.choice

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(low, high)))

    def prose(low: int, high: int) -> str:
        return " ".join(words(4, 18).replace(" ", pick([" ", ", "]), 1).capitalize() + "." for _ in range(rng.randint(low, high)))

    def links(k: int, wrap: str = "li") -> str:
        return "".join(f'<{wrap}><a href="/x">{words(1, 3)}</a></{wrap}>' for _ in range(k))

    def page() -> tuple[str, list[int]]:
        out: list[str] = []
        labels: list[int] = []

        def add(html: str, label: int, count: int = 1) -> None:
            out.append(html)
            labels.extend([label] * count)

        def menu() -> None:
            k = rng.randint(2, 7)
            open_, close = pick([("<nav><ul>", "</ul></nav>"), ('<div class="menu"><ul>', "</ul></div>"), ('<ul id="navigation">', "</ul>"), ('<div role="navigation"><ul>', "</ul></div>")])
            add(open_ + links(k) + close, 0, k)

        def header() -> None:
            open_, close = pick([("<header>", "</header>"), ('<div id="header">', "</div>"), ('<div class="masthead">', "</div>")])
            add(f"{open_}<{pick(['div', 'h1', 'p'])}>{words(1, 4)}</div>{close}", 0)

        def footer() -> None:
            open_, close = pick([("<footer>", "</footer>"), ('<div class="footer">', "</div>"), ('<div id="colophon">', "</div>")])
            text = pick([f"&copy; {words(1, 2)} &middot; {prose(1, 2)}", f"{words(3, 8)}", f"{prose(1, 1)}"])
            add(f"{open_}{pick(['<p>', ''])}{text}{close}", 0)

        def advert() -> None:
            text = pick([words(3, 10), prose(1, 3)])
            add(f'<div class="{pick(["ad", "advert", "sponsored", "promo box", "ad-slot"])}">{pick(["<p>", ""])}{text}</div>', 0)

        def notice() -> None:
            add(f'<div {pick(["class", "id"])}="{pick(["cookie-notice", "consent", "alert", "gdpr popup", "notice"])}"><p>{prose(1, 2)}</p></div>', 0)

        def side() -> None:
            open_, close = pick([("<aside>", "</aside>"), ('<div class="sidebar">', "</div>"), ('<div class="related widget">', "</div>")])
            k = rng.randint(1, 4)
            if rng.random() < 0.5:
                add(f"{open_}<h3>{words(1, 3)}</h3><ul>{links(k)}</ul>{close}", 0, k + 1)
            else:
                add(f"{open_}<h3>{words(1, 3)}</h3><p>{prose(1, 3)}</p>{close}", 0, 2)

        def form() -> None:
            open_ = pick(["<form>", '<form class="newsletter">', '<form id="search">'])
            add(f"{open_}<p>{pick([words(2, 5), prose(1, 1)])}</p><input><button>{words(1, 2)}</button></form>", 0, 2)

        def share() -> None:
            k = rng.randint(2, 4)
            add(f'<div class="{pick(["share", "social", "tags"])}"><ul>{links(k)}</ul></div>', 0, k)

        def comments() -> None:
            k = rng.randint(1, 4)
            open_, close = pick([('<section class="comments">', "</section>"), ('<div id="comments">', "</div>"), ('<ol class="commentlist">', "</ol>")])
            row = lambda: f'<div class="{pick(["comment", "reply", "comment-body"])}"><p>{prose(1, 4)}</p></div>'
            add(f"{open_}<h3>{words(1, 2)}</h3>{''.join(row() for _ in range(k))}{close}", 0, k + 1)

        def article() -> None:
            open_, close = pick([
                ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                ('<div class="content">', "</div>"), ('<div id="main">', "</div>"), ('<div class="post-body entry">', "</div>"),
                ('<div class="story">', "</div>"), ('<div class="c7">', "</div>"), ("<section>", "</section>"), ("<table><tr><td>", "</td></tr></table>"),
            ])
            out.append(open_)
            if rng.random() < 0.85:
                title = f"<h1>{words(3, 9)}{pick(['', '.'])}</h1>"
                add(title if rng.random() < 0.8 else f"<header>{title}</header>", 1)
            for _ in range(rng.randint(1, 9)):
                kind = rng.random()
                if kind < 0.60:
                    add(f"<p>{prose(1, 7)}{pick(['</p>', '</p>', ''])}", 1)
                elif kind < 0.68:
                    add(f"<p><b>{prose(1, 4)}<br>", 1)
                elif kind < 0.73:
                    add(f"<p>{prose(1, 2)} <a href='/y'>{words(1, 3)}</a> {prose(1, 2)}</p>", 1)
                elif kind < 0.78:
                    add(f"<h2>{words(2, 6)}</h2>", 1)
                elif kind < 0.82:
                    k = rng.randint(2, 5)
                    add(f"<ul>{''.join(f'<li>{prose(1, 2)}</li>' for _ in range(k))}</ul>", 1, k)
                elif kind < 0.86:
                    add(f"<blockquote>{prose(1, 3)}</blockquote>", 1)
                elif kind < 0.89:
                    add(f"<p>{words(1, 4)}{pick(['.', '', '!', '&&&', '***'])}</p>", 1)
                elif kind < 0.91:
                    add(f"<figure><img src='z'><figcaption>{prose(1, 1)}</figcaption></figure>", 1)
                else:
                    pick([advert, side, form, share, notice])()
            if cut_off:
                add(f"<p>{prose(1, 3)}{words(1, 5)}", 1)
                return
            if rng.random() < 0.15:
                comments()
            out.append(close)

        noise = [menu, header, advert, notice, side, form, share]
        for make in rng.sample(noise, rng.randint(0, 4)):
            make()
        cut_off = rng.random() < 0.1
        article()
        if cut_off:
            return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{''.join(out)}", labels
        for make in rng.sample([advert, side, form, share, comments, notice, menu], rng.randint(0, 4)):
            make()
        if rng.random() < 0.85:
            footer()
        body = "".join(out)
        return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><script>x()</script></head><body>{body}</body></html>", labels

    return [page() for _ in range(n)]


def trained(pages: list[tuple[str, list[int]]]) -> Field:
    """Weights that maximise the penalised likelihood of the pages' labels."""
    read = [(blocks_of(html), labels) for html, labels in pages]
    for blocks, labels in read:
        if len(blocks) != len(labels):
            raise ValueError(f"{len(blocks)} blocks, {len(labels)} labels")
    names = sorted({f for blocks, _ in read for b in blocks for f in b.features})
    number = {f: i for i, f in enumerate(names)}
    longest = max(len(b) for b, _ in read)
    x = np.zeros((len(read), longest, len(names)), np.float32)
    y = np.zeros((len(read), longest), np.int64)
    there = np.zeros((len(read), longest), bool)
    for i, (blocks, labels) in enumerate(read):
        there[i, : len(labels)] = True
        y[i, : len(labels)] = labels
        for j, block in enumerate(blocks):
            x[i, j, [number[f] for f in block.features]] = 1
    total = there.sum()
    truth = np.eye(2)[y] * there[..., None]
    pair = there[:, 1:] & there[:, :-1]
    seen = np.einsum("pta,ptb,pt->ab", truth[:, :-1], truth[:, 1:], pair)
    params = np.zeros(2 * len(names) + 4)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, change = params[:-4].reshape(len(names), 2), params[-4:].reshape(2, 2)
        score = (x.reshape(-1, len(names)) @ w).reshape(len(read), longest, 2)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + change, axis=1) + score[:, t]
            ahead[:, t][~there[:, t]] = ahead[:, t - 1][~there[:, t]]
        for t in range(longest - 2, -1, -1):
            more = np.logaddexp.reduce(change[None] + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(there[:, t + 1][:, None], more, 0)
        whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
        share = np.exp(ahead + behind - whole[:, None, None]) * there[..., None]
        both = np.exp(
            ahead[:, :-1, :, None] + change + (score + behind)[:, 1:, None, :] - whole[:, None, None, None]
        ) * pair[..., None, None]
        slope_w = x.reshape(-1, len(names)).T @ (truth - share).reshape(-1, 2)
        slope = np.concatenate([slope_w.ravel(), (seen - both.sum(axis=(0, 1))).ravel()]) / total
        slope -= PENALTY / len(read) * params
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        params = params + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    w = params[:-4].reshape(len(names), 2)
    return Field({f: (float(w[i, 0]), float(w[i, 1])) for f, i in number.items()}, params[-4:].reshape(2, 2))


def html_extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    field = field or trained(labelled_pages())

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                text = [field.text(html.as_py()) for html in part.column("html")]
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    kinds = dict(pages.dtypes)
    return (
        pages.select("page_id", "url", "html")
        .mapInArrow(extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
