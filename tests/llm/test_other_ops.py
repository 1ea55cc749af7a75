"""Mixing, sharding, HTML and embeddings against plain models, and their defined cases."""

import collections
import random
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidlake.llm import embed, html, mixing, sharding
from evidlake.llm.common import connected_components


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(80)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    for at_once in (1 << 20, 10):  # in one task, and by stars
        got = connected_components(spark, spark.createDataFrame(edges, "u long, v long"), at_once=at_once).collect()
        assert len(got) == len(root) and {r["node"]: r["component"] for r in got} == {x: find(x) for x in root}
    assert connected_components(spark, spark.createDataFrame([], "u long, v long")).count() == 0


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(-1)).withColumn("shard", F.lit("clash"))


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(rng.randrange(0, 200))), rng.choice(["a"] * 6 + ["b", "c", "d", None])) for i in range(300)]
    return [*rows, (300, None, "a"), (301, "x " * 20000, "b"), (302, "", None), (None, "no id", "z"), (5, *rows[5][1:]), *((None, f"no id {i} " + "w " * (i % 40), "a") for i in range(60))]


def fill(sizes, weights, share, most):
    """Targets by repeated resharing, as the contract words it."""
    out = dict.fromkeys(sizes, 0.0)
    total, open_ = share * sum(sizes.values()), set(sizes)
    while open_:
        level = total / sum(weights[s] for s in open_)
        above = {s for s in open_ if weights[s] * level > most * sizes[s]}
        if not above:
            out.update({s: weights[s] * level for s in open_})
            break
        for s in above:
            out[s] = most * sizes[s]
            total -= out[s]
        open_ -= above
    return out


def test_mixing_meets_targets(spark, sources):
    mix = mixing.Mix(spark, docs(spark, sources), block=16)
    got = mix.taken().collect()
    assert len(got) == len(sources)
    size, taken = collections.Counter(), collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = fill(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == size[r["source"]]
    assert all(abs(taken[s] - want[s]) <= 32 for s in order)
    again = mixing.Mix(spark, docs(spark, sources).repartition(7), block=16).taken()
    key = lambda rows: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rows)
    assert key(again.collect()) == key(got)
    slots = mix.slots.collect()
    assert len({(s["shard"], s["sid"], s["slot"]) for s in slots}) == len(slots)
    by = collections.Counter((s["sid"], s["pass"], s["block"]) for s in slots)
    assert max(by.values()) == 1  # a permutation in each pass
    assert mixing.Mix(spark, docs(spark, [])).taken().count() == 0


def test_mixing_meets_targets_of_small_sources(spark):
    rows = [(i, "w " * n, f"s{i:02}") for i, n in enumerate([3, 10, 10, 7, 40, 90, 25, 300, 5000, 1, 12, 70])]
    got = mixing.Mix(spark, docs(spark, rows)).taken().collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r["taken"] - r["target"]) <= max(1, 0.05 * r["target"]), r


def test_mixed_texts_hold_the_taken_words(spark, sources):
    rows = [r for r in sources if r[0] not in (5, None)]
    mix = mixing.Mix(spark, docs(spark, rows), block=16, keep=("doc_id", "text"))
    taken = {r["doc_id"]: r["taken"] for r in mix.taken().collect()}
    text = dict((r[0], r[1]) for r in rows)
    got = collections.Counter()
    for r in mix.texts().collect():
        own = r["text"].split()
        got[r["doc_id"]] += len(own)
        assert set(own) <= set(text[r["doc_id"]].split())
    assert got == {k: v for k, v in taken.items() if v}


def test_permutations(spark):
    rows = spark.range(0, 40).selectExpr("id + 1 AS n").selectExpr("n", "explode(sequence(0L, n - 1)) AS x").crossJoin(spark.range(2).withColumnRenamed("id", "k"))
    got = collections.defaultdict(list)
    for r in mixing.permute(rows, "x", "n", ["k"], "y").collect():
        got[r["n"], r["k"]].append((r["x"], r["y"]))
    assert all(sorted(y for _, y in v) == list(range(n)) for (n, _), v in got.items())
    assert sorted(got[40, 0]) != sorted(got[40, 1])


def test_sharding_matches_a_plain_model(spark, sources):
    import hashlib

    rows = [r for r in sources if r[0] is not None and (r[0], r[1]) != (5, None)]
    rows = list({r[0]: r for r in rows}.values())
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(docs(spark, rows), 8).collect()}
    h = lambda d: hashlib.md5(f"{sharding.SEED}:{d}".encode()).hexdigest()
    by = collections.defaultdict(list)
    for d, _, s in rows:
        by["-" if s is None else "s" + s].append(d)
    line = []
    for s, ids in by.items():
        for k, d in enumerate(sorted(ids, key=lambda d: (h(d), d))):
            line.append(((2 * k + 1) / (2 * len(ids)), s, h(d), d))
    n, slots = len(line), collections.Counter()
    for pos, (_, _, _, d) in enumerate(sorted(line)):
        shard = pos * 8 // n
        assert got[d] == (shard, slots[shard])
        slots[shard] += 1
    assert max(slots.values()) - min(slots.values()) <= 1


def test_sharding_odd_cases(spark, sources):
    got = sharding.interleave(docs(spark, sources), 8).collect()
    assert len(got) == len(sources)
    per = collections.defaultdict(list)
    for r in got:
        per[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert sorted(r["shard"] for r in sharding.interleave(docs(spark, sources[:3]), 8).collect()) == [0, 2, 5]
    assert sharding.interleave(docs(spark, []), 8).count() == 0


PAGES = [
    ("<html><body><nav><a href=x>Menu one, two, three</a></nav><article><h1>A &amp; B</h1><p><b>First para,<br>  with  text.<p>Second &lt;para&gt;.</p></article><footer>&copy; foot</footer>", "A & B\nFirst para, with text.\nSecond <para>."),
    ('<body><div class="cookie-notice">We use cookies, as all do.</div><div id="c"><h2>Title</h2><p>Long text here, with many words. And more, really.<p>Short.<ul><li>one<li>two</ul><form><p>Mail me, please.</form></div><div class="comments"><p>Nice text, I liked it a lot, thank you very much indeed.</p></div>', "Title\nLong text here, with many words. And more, really.\nShort.\none\ntwo"),
    ("<main><p>Only, this.</p><script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --></main><aside>Side text that is long, and longer, and longest.</aside>", "Only, this."),
    ("plain text, without tags", "plain text, without tags"),
    ("<p>unclosed <b>bold, text <a", "unclosed bold, text"),
    ("", ""),
    (None, ""),
    ("<html><head><title>T</title></head><body></body></html>", ""),
    ("<article>" + "<div>" * 500 + "deep, text" + "</div>" * 500 + "</article>", "deep, text"),
    ("<article><p>a&nbsp;b &#233; &unknown; &am</p></article>", "a b é &unknown; &am"),
]


def test_html_cases(spark):
    rows = [(i, "u", p, "clash") for i, (p, _) in enumerate(PAGES)]
    got = {r["page_id"]: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert got[i]["text"] == want, i
        assert got[i]["n_chars"] == len(want)
    long = "<article>" + "".join(f"<p>Paragraph {i}, with words.</p>" for i in range(20000)) + "</article>"
    assert html.content(long).count("\n") == 19999


def test_html_keeps_all_parts_of_an_article_and_marked_wrappers():
    say = "Words of the text, with commas, and more. "
    t = say.strip()
    body, part = (say * 17).strip(), (say * 3).strip()
    whole = f"T\n{body}\n{part}"
    inner = f"<h1>T</h1><div class=body><p>{body}</p></div><section><p>{part}</p></section>"
    assert html.content(f"<body><article>{inner}</article>") == whole
    assert html.content(f"<body><div>{inner}</div>") in (whole, body)  # a short part may be below the threshold here
    two = f"<body><div id=c><h2>T</h2><div class=x><p>{body}</p></div><div class=y><p>{body}</p><p>{body}</p></div></div><div>Short</div>"
    assert html.content(two) == f"T\n{body}\n{body}\n{body}"
    assert html.content(f"<div id=c><div class=x><p>{body}</p></div><div class=y><p>{part} {part}</p></div></div>") == f"{body}\n{part} {part}"
    for page in ("<article class='post has-sidebar'>{}</article>", "<div id='page' class='no-comments'><article>{}</article></div>", "<main><p>Lead</p><div class=with-sidebar><article>{}</article></div></main>"):
        assert html.content("<body>" + page.format(inner)).endswith(whole), page
    side = f"<div class=sidebar><article><p>{part}</p></article></div>"
    for page in (f"{side}<article>{inner}</article>", f"<div class=no-comments>{side}<article>{inner}</article></div>", f"<article>{inner}<div class=comments><article class=comment><p>{part}</p></article></div></article>"):
        assert html.content(f"<body>{page}") == whole, page
    assert html.content(f"<article class=hero>{t}</article><div class=comments><p>{part}</p></div>") == t


def test_html_marks_need_whole_tokens_and_media_are_content():
    say = "Long sentence, with words and commas, of the article itself."
    for page in ('<body><div class="content has-sidebar"><article><p>%s</article></div>', '<div id="main" class="with-menu"><article><p>%s</p></article></div>', '<article class="social-policy"><p>%s</p></article>'):
        assert html.content(page % say) == say, page
    for page in ('<article><p>A, b.</p><p class="notice-period">%s</p></article>', '<article><p>A, b.</p><section class="search-results-analysis"><p>%s</p></section></article>'):
        assert html.content(page % say) == f"A, b.\n{say}", page
    assert html.content(f"<article><p>Energy is <math><mi>E</mi></math> as known. {say}</p></article>") == f"Energy is E as known. {say}"
    assert html.content(f"<article><svg><path d=x><p>{say}</p></article><p>after</p>") == say
    assert html.content(f"<article><p>A <object>plan</object>, a <canvas>curve</canvas>, a <video>film</video>.</p><p>{say}<style>p {{}}</article>") == f"A plan, a curve, a film.\n{say}"
    assert html.content(f"<button>more<p>{say}</p>") == say
    for token in ("cookie-notice", "ad-box", "related-posts", "comments", "newsletter_signup"):
        assert html.content(f"<article><p>{say}</p><div class='x {token}'><p>{say}</p></div></article>") == say, token


def test_html_attributes_are_read_by_name():
    say = "Long sentence, with words and commas, of the article itself."
    for page in ('<div style="overflow: hidden"><p>%s</p></div>', '<body style="overflow: hidden"><p>%s</p>', '<div data-state="hidden"><p>%s</p></div>', '<p title="a hidden gem">%s</p>', "<p title=\"a > b\" data-x='<i>'>%s</p>", "<p title=it's>%s</p>"):
        assert html.content(page % say) == say, page
    for part in ("<p hidden>%s</p>", "<p hidden=''>%s</p>", "<p aria-hidden=true>%s</p>", "<p class=x hidden >%s</p>"):
        assert html.content(f"<article><p>{say}</p>{part % 'Not this, ever.'}</article>") == say, part


def test_html_reader_comments_are_found_by_structure():
    say = "Long sentence, with words and commas, of the article itself."
    one = "<{0} class=x><span class=author>Ann</span> <time>2 days ago</time><p>I liked it, really, a lot.</p></{0}>"
    parts = [f'<div id="user-comments-list"><p>{say}</p></div>', f'<section class="reader-comments"><p>{say}</p></section>', f"<div class=q>{one.format('div') * 3}</div>", f"<section><h3>3 Comments</h3>{one.format('div')}</section>", f"<ol>{one.format('li') * 2}</ol>", f"<h2>Comments (3)</h2><div><p>{say}</p></div>"]
    for part in parts:
        for page in (f"<article><h1>T</h1><p>{say}</p>{part}</article>", f"<main><article><h1>T</h1><p>{say}</p></article>{part}</main>", f"<div class=page><h1>T</h1><p>{say} {say}</p>{part}</div>"):
            assert html.content(page) in (f"T\n{say}", f"T\n{say} {say}"), page
    for part in (f"<div class=no-comments><p>{say}</p></div>", f"<p class=comment-count>{say}</p>", f"<h2>Comments on the law</h2><p>{say}</p>", f"<p><span class=author>Ann</span> <time>2024-05-01</time></p><p>{say}</p>"):
        assert html.content(f"<article><p>{say}</p>{part}</article>").endswith(say) and html.content(f"<article><p>{say}</p>{part}</article>").count("\n"), part


def test_html_time_is_in_proportion_to_length():
    made = {"tags": lambda n: "<b " * n + '"', "stray ends": lambda n: "<div>" * n + "</p>" * n, "items": lambda n: "<div>" * n + "<li>x" * n, "marks": lambda n: "<div class=ad>" * n + "x", "drawings": lambda n: "<svg><p>x" * n + "</svg>", "quotes": lambda n: '<p a="' * n, "raw": lambda n: "<div><textarea>" * n, "deep": lambda n: "<div><p>x" * n, "headings": lambda n: "<div><h3>Comments</h3>" * n}
    for name, page in made.items():
        took = []
        for n in (2000, 16000):
            best = 9e9
            for _ in range(3):
                began = time.perf_counter()
                html.content(page(n))
                best = min(best, time.perf_counter() - began)
            took.append(best)
        assert took[1] < 0.2 + 24 * took[0], (name, took)  # eight times the length; a square would take 64 times


def test_html_of_empty_and_repeated_rows(spark):
    schema = "page_id long, url string, html string"
    assert html.extract(spark.createDataFrame([], schema)).collect() == []
    row = (None, None, "<p>Text, twice.</p>")
    assert [tuple(r) for r in html.extract(spark.createDataFrame([row, row], schema)).collect()] == [(None, None, "Text, twice.", 12)] * 2


def test_html_on_pages_without_article_or_main():
    """Random pages of divisions alone, against the parts they were made of."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    say = lambda n: ", ".join(" ".join(word() for _ in range(6)) for _ in range(n)) + "."
    for _ in range(300):
        menu = "<div class=m{}><ul>" + "".join(f"<li><a href=x>{word()}</a>" for _ in range(rng.randrange(3, 12))) + "</ul></div>"
        noise = [menu.format(1), f"<div class=ad><p>{say(3)}</p></div>", f"<div class='cookie-notice'><p>{say(2)}</p></div>", f"<div id=comments><p>{say(4)}</p><p>{say(4)}</p></div>", f"<footer><p>{say(2)}</p></footer>", f"<nav>{word()}</nav>", f"<form><p>{say(2)}</p></form>"]
        title, parts = say(1), [say(rng.randrange(4, 12)) for _ in range(rng.randrange(3, 9))]
        body = f"<h2>{title}</h2>" + "".join(f"<p>{p}" for p in parts) + (menu.format(2) if rng.random() < 0.5 else "")
        wrap = rng.choice(["<div class='text has-ads'>{}</div>", "<div id=page class=no-comments><div class=t>{}</div></div>", "<table><tr><td>{}</td></tr></table>", "<section>{}</section>", "<div class=sidebar><div>{}</div></div>" if rng.random() < 0.3 else "<div>{}</div>"])
        before, after = rng.sample(noise, 2), rng.sample(noise, 2)
        if "sidebar" in wrap:
            before = after = [menu.format(1)]
        got = html.content("<html><body>" + "".join(before) + wrap.format(body) + "".join(after))
        assert got == "\n".join([title, *parts]), (wrap, before, after)


def brute_links(rows, threshold):
    x, ok = [], []
    for i, (k, v) in enumerate(rows):
        if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v):
            a = np.array(v, dtype=np.float32).astype(float)
            x.append(a / np.linalg.norm(a))
            ok.append(i)
    g = np.array([[len(a) == len(b) and a @ b >= threshold for b in x] for a in x])
    return ok, g


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    centre = rng.normal(size=16)
    rows += [(300 + i, (centre + rng.normal(size=16) * 0.12).tolist()) for i in range(200)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]
    rows += [(600 + i, (np.array(rows[i][1]) + rng.normal(size=16) * 0.1).tolist()) for i in range(100)]
    rows += [(900, rows[1][1]), (900, rows[2][1])]  # one id with two vectors
    rows += [(800, None), (801, [0.0] * 16), (802, [float("nan")] + [1.0] * 15), (803, [None] + [1.0] * 15), (804, [1.0, 2.0]), (805, [float("inf")] * 16), (None, rows[1][1]), (806, []), (807, [1.0, 2.0]), (808, [2.0, 1.0]), (809, [1.0, 2.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit("clash"))
    got = embed.near_duplicates(spark, vectors, cell=32).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: r for r in got}
    ok, g = brute_links(rows, embed.THRESHOLD)
    ids = [rows[i][0] for i in ok]
    found = sum(r["n_links"] for r in got)
    true = int(g.sum()) - len(ids)
    assert true > 20000 and 0.995 * true <= found <= true
    assert all(by[k]["n_links"] <= row.sum() - 1 for k, row in zip(ids, g, strict=True) if k != 900)
    assert all(by[k]["n_links"] == 0 and by[k]["component_id"] == k and by[k]["kept"] for k in (800, 801, 802, 803, 805, 806))
    assert [(by[k]["n_links"], by[k]["component_id"]) for k in (804, 807, 808, 809)] == [(1, 804), (1, 804), (0, 808), (0, 809)]
    assert by[None]["n_links"] == by[1]["n_links"] and by[None]["component_id"] == 1 and not by[None]["kept"]
    two = sorted((r["component_id"], r["n_links"]) for r in got if r["vec_id"] == 900)
    assert two == [(1, by[1]["n_links"]), (2, by[2]["n_links"])] and {by[1]["component_id"], by[2]["component_id"]} == {1, 2}
    assert by[500]["component_id"] == 0 and not by[500]["kept"] and by[0]["kept"]
    assert embed.near_duplicates(spark, vectors.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(5)
    d = 64
    o = rng.normal(size=d)
    o /= np.linalg.norm(o)
    q = o + rng.normal(size=d) * 0.05
    q /= np.linalg.norm(q)
    est = []
    for k in range(400):
        turn = embed.rotations(d, 1, k)[0]
        code = np.where(turn @ o > 0, 1, -1) / np.sqrt(d)
        est.append((turn @ q) @ code / (code @ (turn @ o)))
    assert abs(np.mean(est) - o @ q) < 4 * np.std(est) / 20
    x = rng.normal(size=(200, d))
    x[100:] = x[:100] + rng.normal(size=(100, d)) * 0.25
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = embed.rotations(d, 1)[0]
    q, c = embed.encode(x[:100], turn), embed.encode(x[100:], turn)
    assert q.signs.nbytes == 100 * d // 8 and c.planes.nbytes == 100 * d * embed.PLANES // 8
    i, j, looked = embed.compare(x[:100], x[100:], q, c, 0.95)
    want = np.nonzero(x[:100] @ x[100:].T >= 0.95)
    assert sorted(zip(i, j, strict=True)) == sorted(zip(*want, strict=True)) and looked < 0.05 * 100 * 100
    for odd in (1, 3, 65, 130):  # lengths that fill no words
        x = rng.normal(size=(60, odd))
        x[30:] = x[:30] + rng.normal(size=(30, odd)) * 0.05
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        turn = embed.rotations(odd, 1)[0]
        i, j, _ = embed.compare(x[:30], x[30:], embed.encode(x[:30], turn), embed.encode(x[30:], turn), 0.95)
        assert set(zip(i, j, strict=True)) == set(zip(*np.nonzero(x[:30] @ x[30:].T >= 0.95), strict=True)), odd


def test_crc_folds(spark):
    from evidlake.llm.langid import fold

    got = spark.range(50).select("id", fold("id", 7).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in got)


class _Tree(HTMLParser):
    """Elements and blocks of a well-formed page, for ``plain_content``."""

    def __init__(self):
        super().__init__()
        self.nodes, self.stack, self.blocks, self.in_link = [("", None)], [0], [], False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.in_link = True
            return
        self.nodes.append((tag + "".join(f".{c}" for c in dict(attrs).get("class", "").split()), self.stack[-1]))
        self.stack.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        if tag == "a":
            self.in_link = False
        else:
            self.stack.pop()

    def handle_data(self, data):
        if self.blocks and self.blocks[-1][0] == self.stack[-1] and self.blocks[-1][3] == len(self.nodes):
            n, text, links, at = self.blocks.pop()
        else:
            n, text, links = self.stack[-1], "", 0
        self.blocks.append((n, text + data, links + len(data.strip()) * self.in_link, len(self.nodes)))


def plain_content(page):
    """The path ratios by their definition, on pages of div and p without marks, article or main."""
    tree = _Tree()
    tree.feed(page)
    up = lambda n: [n] if n == 0 else [n, *up(tree.nodes[n][1])]
    path = lambda n: tuple(tree.nodes[x][0] for x in reversed(up(n)))
    blocks = [(n, " ".join(t.split()), k) for n, t, k, _ in tree.blocks if t.strip()]
    stats = {}
    for n, t, k in blocks:
        s = stats.setdefault(path(n), [0, 0, 0, 0])
        for i, v in enumerate((len(t), sum(c in ".,;:!?" for c in t), min(k, len(t)), 1)):
            s[i] += v
    mean = [[s[i] / s[3] for s in stats.values()] for i in (0, 1)]
    even = lambda v: [sum(w * v[min(max(i + d, 0), len(v) - 1)] for d, w in ((-1, 0.25), (0, 0.5), (1, 0.25))) for i in range(len(v))]
    score = {p: a * (1 + b) * (1 - s[2] / s[0]) for (p, s), a, b in zip(stats.items(), *map(even, mean), strict=True)}
    if max(score.values()) <= 0:
        return ""
    chosen = {n for n, _, _ in blocks if score[path(n)] >= 0.25 * max(score.values())}
    root = next(x for x in up(min(chosen)) if all(x in up(n) for n in chosen))
    while tree.nodes[root][0].split(".")[0] == "p":
        root = tree.nodes[root][1]
    part = lambda n: next((x for x in up(n) if x == root or tree.nodes[x][1] == root), None)
    inside = [(part(n), n, t, k) for n, t, k in blocks if root in up(n)]
    held = {p: (sum(len(t) for q, _, t, _ in inside if q == p), sum(k for q, _, _, k in inside if q == p), any(n in chosen for q, n, _, _ in inside if q == p)) for p, *_ in inside}
    return "\n".join(t for p, _, t, _ in inside if held[p][2] or held[p][1] < 0.5 * held[p][0])


def test_html_path_ratios_against_a_plain_model():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))

    def say():
        body = " ".join(word() + rng.choice(["", "", "", ",", "."]) for _ in range(rng.choice([2, 3, 8, 30, 60])))
        return f"<a href=x>{body}</a>" if rng.random() < 0.25 else body

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            return f'<p class="k{rng.randrange(3)}">{say()}</p>'
        return f'<div class="c{rng.randrange(4)}">' + "".join(make(depth - 1) for _ in range(rng.randrange(1, 5))) + "</div>"

    different = set()
    for _ in range(400):
        page = '<div class="top">' + "".join(make(rng.randrange(1, 4)) for _ in range(rng.randrange(1, 5))) + "</div>"
        got = html.content(page)
        assert got == plain_content(page), page
        different.add(got.count("\n") + 1 < page.count("<p"))
    assert different == {True, False}  # some pages lose parts, some none
