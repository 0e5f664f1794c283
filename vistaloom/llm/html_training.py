"""Trains the block labeller: python -m vistaloom.llm.html_training

The pages are made here, with a label for every text they hold: site furniture of many kinds and
names around an article, in regular and broken markup. Names that carry no meaning are mixed in, so
that a label rests on several signs. The weights go to labeller.npz beside this file.
"""

import html
import os
import random

import numpy as np

from .html import SIZE, Labeller, blocks_of, features

FURNITURE = {
    "nav": "nav menu navbar navigation topnav main-menu breadcrumb breadcrumbs crumbs tabs site-nav",
    "header": "header masthead top-bar site-header branding logo page-header banner",
    "footer": "footer site-footer bottom copyright legal colophon imprint",
    "aside": "sidebar aside widget related related-posts recommended popular trending tags categories archive toc promo-box",
    "ad": "ad ads advert advertisement sponsored sponsor promo adbox banner-ad ad-slot partner dfp",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay subscribe newsletter paywall toast cookie-banner",
    "form": "form login search-form signup contact-form feedback poll searchbox register",
    "comments": "comments comment comment-list replies reply discussion responses disqus comment-body reader-comments respond",
    "share": "share social sharing follow likes author-box byline-meta pagination pager print tools",
}
TAGS = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "ad": ["div", "aside", "section", "ins"], "notice": ["div", "section", "aside", "p"], "form": ["form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "ul", "section"]}
ARTICLE = ["article", "main", "div.content", "div.post", "div.entry-content", "div.article-body", "div#content", "section.story", "div.post-content", "div#main", "article.post", "div.text", "div.body", "main#main-content", "td.maintext", "div"]
SPOKEN = {
    "nav": "home about contact news products services blog login menu help sitemap".split(),
    "header": "welcome the official site of your daily source".split(),
    "footer": "copyright all rights reserved privacy policy terms of use imprint © 2024 · contact".split(),
    "aside": "related articles popular posts read more archive categories tags recent".split(),
    "ad": "advertisement sponsored buy now offer sale discount click here free shipping".split(),
    "notice": "we use cookies accept all manage consent subscribe to our newsletter sign up".split(),
    "form": "name email password submit search send your message login remember me".split(),
    "comments": "says reply comment posted ago great article thanks i think you are right".split(),
    "share": "share tweet facebook email print follow us next previous page".split(),
}


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.out: list[str] = []
        self.labels: list[tuple[str, bool]] = []
        self.table = False
        parts = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve sch ung ich ein que ción mente los ê é ö ü ñ ment eau oi".split()
        self.words = ["".join(self.r.choices(parts, k=self.r.randint(1, 4))) for _ in range(300)]

    def sentence(self, n: int) -> str:
        w = self.r.choices(self.words, k=n)
        return (" ".join(x + ("," if self.r.random() < 0.06 else "") for x in w)).capitalize().rstrip(",") + self.r.choice([".", ".", ".", "", "!", "?"])

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.sentence(self.r.randint(2, 18)) for _ in range(self.r.randint(low, high)))

    def text(self, s: str, main: bool) -> str:
        """Escaped text whose words are labelled."""
        if self.r.random() < 0.1:
            s += self.r.choice([" & co", " < 5", " “quoted”", " §§§", " 100%", " a|b"])
        self.labels.append((" ".join(s.split()), main))
        return html.escape(s, quote=False)

    def row(self) -> str:
        """A new row of a page that is one table, or another cell of the row."""
        return "<tr>" if self.r.random() < 0.7 else ""

    def noise(self) -> str:
        r = self.r
        return "" if r.random() < 0.6 else f' {r.choice(["class", "id"])}="{r.choice(["wrap", "row", "col-8", "container", "inner", "box", "x" + str(r.randint(1, 99)), "".join(r.choices("abcdefghij", k=5)), "block", "module", "section-2", "grid"])}"'

    def furniture(self, kind: str) -> None:
        r = self.r
        tag = r.choice(TAGS[kind])
        name = r.choice(FURNITURE[kind].split())
        if self.table and kind in ("nav", "footer", "header", "aside"):
            tag = "td"
        elif r.random() < 0.25:
            name += " " + r.choice(FURNITURE[kind].split())
        own = tag == "td" or tag in ("nav", "header", "footer", "aside", "form") and r.random() < 0.5  # no name
        mark = "" if own else f' {r.choice(["class", "class", "id"])}="{name}"'
        self.out.append((self.row() if tag == "td" else "") + f"<{tag}{mark}>")
        words = SPOKEN[kind]

        def phrase(n: int) -> str:
            return " ".join(r.choice(words if r.random() < 0.4 else self.words) for _ in range(n))

        if kind in ("nav", "aside", "share", "footer") and r.random() < 0.15:
            # Links end to end, a line each or with marks between them; in table cells on older pages.
            between, cells = r.choice(["<br>", "<br/>", " | ", " ", " · "]), tag == "div" and r.random() < 0.6
            links = []
            for _ in range(r.randint(2, 8)):
                words_ = phrase(r.randint(1, 3))
                links.append((words_, f'<a href="/{r.randint(1, 99)}">'))
            if between.startswith("<"):
                row = between.join(f"{a}{self.text(t, False)}</a>" for t, a in links)
            else:
                self.labels.append((" ".join(between.join(t for t, _ in links).split()), False))
                row = between.join(f"{a}{html.escape(t, quote=False)}</a>" for t, a in links)
            self.out.append(f"<table><tr><td>{row}</td></tr></table>" if cells else row)
        elif kind in ("nav", "aside", "share") and r.random() < 0.85:
            if kind == "aside" and r.random() < 0.5:
                self.out.append(f"<h3>{self.text(phrase(2), False)}</h3>")
            listed = r.random() < 0.8 and tag != "ul"
            self.out.append("<ul>" if listed else "")
            for _ in range(r.randint(2, 9)):
                item = self.text(phrase(r.randint(1, 4)), False)
                item = f'<a href="/{r.randint(1, 99)}">{item}</a>' if r.random() < 0.85 else item
                self.out.append(f"<li>{item}</li>" if listed or tag == "ul" else f"<p>{item}</p>")
            self.out.append("</ul>" if listed else "")
        elif kind == "comments":
            for _ in range(r.randint(1, 5)):
                t = r.choice(["p", "div", "li"])
                if r.random() < 0.5:
                    self.out.append(f"<h4>{self.text(phrase(2), False)}</h4>")
                self.out.append(f"<{t}>{self.text(self.prose(1, 5) if r.random() < 0.7 else phrase(8), False)}</{t}>")
        elif kind == "form":
            for _ in range(r.randint(1, 4)):
                self.out.append(f"<label>{self.text(phrase(r.randint(1, 3)), False)}</label><input type=text>")
            self.out.append(f"<button>{self.text(phrase(1), False)}</button>")
        else:
            for _ in range(r.randint(1, 3)):
                s = self.text(self.prose(1, 3) if r.random() < 0.5 else phrase(r.randint(2, 12)), False)
                t = r.choice(["p", "div", "span", ""])
                self.out.append(f"<{t}>{s}</{t}>" if t and not (t == "p" and tag == "p") else s)
                if t in ("span", ""):
                    break  # one block for running text
        self.out.append(f"</{tag}>")

    def article(self) -> None:
        r = self.r
        spec = r.choice(ARTICLE if r.random() < 0.7 else ARTICLE[:2])
        tag = spec.split(".")[0].split("#")[0]
        mark = f' class="{spec.split(".")[1]}"' if "." in spec else f' id="{spec.split("#")[1]}"' if "#" in spec else ""
        if self.table:
            tag, mark = "td", r.choice(["", "", ' class="content"', " valign=top"])
        self.out.append((self.row() if self.table else "<table><tr>" if tag == "td" else "") + f"<{tag}{mark}>")
        title = self.sentence(r.randint(2, 9))
        if r.random() < 0.85:
            self.out.append(f"<{(t := r.choice(['h1', 'h1', 'h2']))}>{self.text(title, True)}</{t}>")
        broken = r.random() < 0.4
        # Most articles have paragraphs; some have plain blocks, or lines that only breaks divide.
        style = r.choices(["p", "div", "br", "named"], [12, 3, 2, 2])[0]
        named = r.choice(['class="para"', 'class="paragraph"', 'class="p"', 'class="text"', f'class="c{r.randint(1, 99)}"', f'id="p{r.randint(1, 99)}"'])
        for _ in range(r.choice([1, 2, 3, 5, 8, 12, 20])):
            what = r.random()
            if what < 0.7:
                s = self.prose(1, r.choice([1, 1, 3, 8, 15]))
                if style != "p":
                    own = self.text(s, True)
                    self.out.append(f"<div>{own}</div>" if style == "div" else f"<div {named}>{own}</div>" if style == "named" else f"{own}{r.choice(['<br><br>', '<br>', '<br/><br/>'])}")
                elif broken and r.random() < 0.3:
                    self.out.append(f"<p><b>{self.text(s, True)}<br>")
                elif r.random() < 0.2:
                    cut = s.find(" ")
                    self.labels.append((" ".join(s.split()), True))
                    self.out.append(f'<p><{(t := r.choice(["b", "em", "a href=x"]))}>{html.escape(s[:cut], quote=False)}</{t[0] if t[0] != "e" else "em"}>{html.escape(s[cut:], quote=False)}</p>' if cut > 0 else f"<p>{html.escape(s, quote=False)}</p>")
                else:
                    self.out.append(f"<p>{self.text(s, True)}" + ("</p>" if not broken or r.random() < 0.7 else ""))
            elif what < 0.78:
                self.out.append(f"<{(t := r.choice(['h2', 'h3']))}>{self.text(self.sentence(r.randint(1, 6)), True)}</{t}>")
            elif what < 0.86:
                self.out.append("<ul>" + "".join(f"<li>{self.text(self.sentence(r.randint(1, 12)), True)}</li>" for _ in range(r.randint(1, 6))) + "</ul>")
            elif what < 0.92:
                self.out.append(f"<blockquote>{self.text(self.prose(1, 3), True)}</blockquote>")
            elif what < 0.94:
                self.out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.text(r.choice(self.words) + str(r.randint(1, 99)), True)}</td>" for _ in range(2)) + "</tr>" for _ in range(r.randint(1, 3))) + "</table>")
            else:
                self.furniture(r.choice(["ad", "share", "aside", "notice"]))
        if r.random() < 0.12:
            self.furniture("comments")
        self.out.append(f"</{tag}>" + ("</tr></table>" if tag == "td" and not self.table else ""))

    def page(self) -> tuple[str, list[tuple[str, bool]]]:
        r = self.r
        self.out, self.labels, self.table = [], [], r.random() < 0.1
        self.out.append(f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{self.sentence(4)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>')
        wraps = r.randint(0, 2) if not self.table else 0
        self.out += [f"<div{self.noise()}>" for _ in range(wraps)] + (["<table>"] if self.table else [])
        before = [k for k in ("notice", "header", "nav", "ad", "form", "aside", "share") if r.random() < {"nav": 0.85, "header": 0.5, "ad": 0.45}.get(k, 0.25)]
        if r.random() < 0.5:
            r.shuffle(before)
        if self.table:
            before = [k for k in before if k in ("header", "nav", "aside")]
        for k in before:
            if k == "ad" and r.random() < 0.5:
                self.out.append("<!-- ad -->")
            self.furniture(k)
        self.article()
        for k in ("comments", "share", "aside", "ad", "form", "notice", "footer"):
            if r.random() < {"footer": 0.85, "comments": 0.35}.get(k, 0.22) and (not self.table or k in ("aside", "footer")):
                self.furniture(k)
        self.out += ["</table>"] if self.table else []
        self.out += ["</div>"] * (wraps if r.random() < 0.9 else 0)
        self.out.append("</body></html>" if r.random() < 0.8 else "")
        return "".join(self.out), self.labels


def labelled(page: str, labels: list[tuple[str, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Features of a page's blocks and their labels: a block has the label of the text it begins with."""
    blocks = blocks_of(page)
    y, k = np.zeros(len(blocks), np.float32), 0
    for i, b in enumerate(blocks):
        rest = b.text
        y[i] = labels[k][1] if k < len(labels) else 0
        while k < len(labels) and rest and rest.startswith(labels[k][0]):  # broken markup may join texts
            rest = rest[len(labels[k][0]) :].lstrip()
            k += 1
    return features(blocks), y


def _padded(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = max(len(y) for _, y in some)
    x, y, m = np.zeros((width, len(some), SIZE), np.float32), np.zeros((width, len(some), 1), np.float32), np.zeros((width, len(some), 1), np.float32)
    for k, (a, b) in enumerate(some):
        x[: len(b), k], y[: len(b), k, 0], m[: len(b), k] = a, b, 1
    return x, y, m


def gradients(model: Labeller, x: np.ndarray, y: np.ndarray, m: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean logistic loss of the blocks and its gradients, back through time."""
    size = model.w["wh0"].shape[0]
    runs = [model.states(x, m, way) for way in (0, 1)]
    joined = np.concatenate([runs[0][0], runs[1][0]], axis=2)
    p = 1 / (1 + np.exp(-(joined @ model.w["v"] + model.w["c"])))
    n = m.sum()
    loss = -(m * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / n
    dz = m * (p - y) / n
    grads = {"v": np.einsum("tbi,tbo->io", joined, dz), "c": dz.sum(axis=(0, 1))}
    dh_all = dz @ model.w["v"].T
    for way in (0, 1):
        wx, wh = model.w[f"wx{way}"], model.w[f"wh{way}"]
        dx, dwh = np.zeros(x.shape[:2] + (4 * size,), np.float32), np.zeros_like(wh)
        dh_next = dc_next = np.zeros((x.shape[1], size), np.float32)
        for t, h, c, i, f, o, g, squashed in reversed(runs[way][1]):
            dh = (dh_all[t, :, way * size : (way + 1) * size] + dh_next) * m[t]
            dc = dc_next * m[t] + dh * o * (1 - squashed**2)
            d = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            dx[t] = d
            dwh += h.T @ d
            dh_next, dc_next = d @ wh.T, dc * f
        flat = dx.reshape(-1, 4 * size)
        grads |= {f"wx{way}": x.reshape(-1, x.shape[2]).T @ flat, f"wh{way}": dwh, f"b{way}": flat.sum(axis=0)}
    return float(loss), grads


def train(pages: int = 12000, hidden: int = 32, epochs: int = 8, seed: int = 11) -> Labeller:
    rng, make = np.random.default_rng(seed), [Maker(s) for s in range(80)]
    data = [labelled(*make[k % 80].page()) for k in range(pages)]
    data = [d for d in data if len(d[1])]
    weights = {"v": rng.normal(0, 0.1, (2 * hidden, 1)), "c": np.zeros(1)}
    for way in (0, 1):
        bias = np.zeros(4 * hidden)
        bias[hidden : 2 * hidden] = 1
        weights |= {f"wx{way}": rng.normal(0, 0.06, (SIZE, 4 * hidden)), f"wh{way}": rng.normal(0, 0.15, (hidden, 4 * hidden)), f"b{way}": bias}
    model = Labeller(weights)
    first, second, step = {k: np.zeros_like(w) for k, w in model.w.items()}, {k: np.zeros_like(w) for k, w in model.w.items()}, 0
    for epoch in range(epochs):
        rate = 0.004 * (1 - epoch / epochs) + 0.0002
        order = sorted(range(len(data)), key=lambda i: (len(data[i][1]) // 8, rng.random()))
        batches = [order[i : i + 32] for i in range(0, len(order), 32)]
        rng.shuffle(batches)
        losses = []
        for b in batches:
            loss, grads = gradients(model, *_padded([data[i] for i in b]))
            losses.append(loss)
            step += 1
            norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1, 2 / norm)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.w[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        print(f"epoch {epoch}: loss {np.mean(losses):.4f}", flush=True)
    return model


def accuracy(model: Labeller, pages: int = 400, seed: int = 1000) -> float:
    """Share of blocks of fresh pages, of makers that training did not see, that are labelled right."""
    right = total = 0
    for k in range(pages):
        x, y = labelled(*Maker(seed + k).page())
        if len(y):
            got = model.logits(x[:, None], np.ones((len(y), 1, 1), np.float32))[:, 0, 0] > 0
            right, total = right + (got == (y > 0)).sum(), total + len(y)
    return right / total


if __name__ == "__main__":
    trained = train()
    print(f"held-out accuracy {accuracy(trained):.4f}")
    np.savez_compressed(os.path.join(os.path.dirname(__file__), "labeller.npz"), **{k: w.astype(np.float16) for k, w in trained.w.items()})
