import random

import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, empty, prose, rows
from tidewell.llm.html_text import extract_text, main_text
from tidewell.llm.licences import TEMPLATES, full_texts, licence_notices, scan_licences
from tidewell.llm.topk import top_k

LONG = "A paragraph that is long enough to be seen as the main text of a page, with some words to spare at its end."
PAGES = [
    (f"<nav><li><a href=x>Home</a></nav><article><h1>Title</h1><p><b>{LONG}<br><p>Short.</p></article><footer>f</footer>", f"Title\n\n{LONG}\n\nShort."),
    (f"<div class='top-menu'>{LONG}</div><div class=body><p>{LONG}<p>Of.</div><div id=sidebar>{LONG}</div>", f"{LONG}\n\nOf."),
    (f"<article class='article has-sidebar'>{LONG}<div class=ad>Buy</div><section id=comments><article><p>{LONG}</article></section></article>", LONG),
    ("<article><p>a &lt; b &amp; c&nbsp;d &#233; 1 < 2</p><script>if (a < b) {'</p>'}</script><style>p{}</style><!-- c --><p>e</article>", "a < b & c d é 1 < 2\n\ne"),
    (f"<main><header><h1>T</h1><p>by me</p></header><p>{LONG}</p><form>Name <input></form><p>cut &am", f"T\n\n{LONG}\n\ncut &am"),
    ("<article><p>x<br>y\n z</p><ul><li>a<li>b</ul><table><tr><td>c</td></tr></table></article", "x y z\n\na\n\nb\n\nc"),
    ("<p>too short to be an article</p>", ""), ("", ""), (None, ""), ("<", "<" * 0), ("plain " * 40, ("plain " * 40).strip()), ("<!-- open <p>x", ""),
    ("<div hidden>" + LONG + "</div>", ""), ("<p>" * 3000 + LONG, LONG),
]


def test_pages():
    for page, text in PAGES:
        assert main_text(page) == text


def test_pages_on_spark(spark):
    df = spark.createDataFrame([(i, "u", page, "old", "x") for i, (page, _) in enumerate(PAGES)], "page_id long, url string, html string, text string, line string")
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    assert got == {i: text for i, (_, text) in enumerate(PAGES)}
    assert extract_text(df.limit(0)).count() == 0
    assert extract_text(df).columns == ["page_id", "url", "line", "text"]


@pytest.mark.parametrize("clashing", [False, True])
def test_licences_of_odd_rows(spark, clashing):
    got = scan_licences(documents(spark, clashing)).collect()
    assert len(got) == len(rows()) and all(r.n_notices == 0 and r.licences == [] and r.best is None for r in got)
    assert scan_licences(empty(spark)).count() == 0


def test_licence_notices(spark):
    mit = next(t for name, t in TEMPLATES if name == "MIT" and len(t) > 100)
    words = mit.split()
    broken = "\n".join(" ".join(words[i: i + 9]) for i in range(0, len(words), 9))
    table = [(1, "Intro.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.\n"), (1, "Intro.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.\n"),
             (2, f"# Head\n\n{broken.upper()}\n\ntail"), (3, "This work is licensed under the GNU General Public License, version 3."),
             (4, "Released under the"), (5, prose(5000, 1)), (6, "Released under the MIT License " * 2)]
    got = {r.doc_id: (r.n_notices, r.licences) for r in scan_licences(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got == {1: (2, ["CC-BY-NC-4.0", "MIT"]), 2: (1, ["MIT"]), 3: (1, ["GPL-3.0"]), 4: (0, []), 5: (0, []), 6: (1, ["MIT"])}
    one = licence_notices(spark.createDataFrame(table[:1], "doc_id long, text string")).collect()
    assert sorted((r.segment, r.licence, r.dice) for r in one) == [(1, "MIT", 1.0), (2, "CC-BY-NC-4.0", 1.0)]


def brute(table, k):
    """Every row but the query's own, scored in whole numbers of any size."""
    import math
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in table
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for row, (i, v) in enumerate(whole):
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for other, (j, w) in enumerate(whole) if other != row)[:k]
            out += [(i, rank + 1, j, max(-2 ** 63 + 1, min(2 ** 63 - 1, -s))) for rank, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("n, width, k", [(0, 4, 10), (3, 4, 10), (400, 7, 10), (900, 16, 3)])
def test_top_k_against_brute_force(spark, n, width, k):
    pick = random.Random(n)
    table = [(i, [round(pick.gauss(0, 1), 1) for _ in range(width)]) for i in range(n)]
    odd = [(None, [1.0] * width), (5000, None), (5100, [None] * width), (5200, [float("nan")] * width), (5300, [float("inf")] * width), (5400, [1.0])]
    table += table[:3] + (odd if n else [])
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>").withColumns({"ids": F.lit(1), "score": F.lit(2), "list": F.lit(3)})
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 100 == 0, k).collect())) == brute(
        [(i, None if v is None else [None if x is None else __import__("numpy").float32(x).item() for x in v]) for i, v in table], k)


def test_top_k_of_repeated_ids_and_large_components(spark):
    table = [(0, [1.0, 0.0]), (2, [300000.0, 0.0]), (3, [1.0, 0.0]), (3, [5.0, 0.0]), (100, [-7.0, 2.0]), (100, [-7.0, 2.0]), (100, [4.0, 1e6])]
    table += [(10 + i, [x, y]) for i, (x, y) in enumerate([(1e12, 3.0), (1e12, 2.0), (-1e12, 1e11), (2e14, -2e14), (123456789012.5, 1.0), (0.0, 0.0)])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 100 == 0, 20).collect())) == brute(table, 20)


def test_top_k_beyond_exact_floats(spark):
    pick = random.Random(8)
    table = [(i, [pick.choice([1, 1e7, 3e9]) * pick.gauss(0, 1) for _ in range(5)]) for i in range(300)]
    table += [(1000 + i, [1e9 + pick.randint(0, 2) / 1024 for _ in range(5)]) for i in range(300)]  # nearly equal, told apart by last digits
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 100 == 0).collect())) == brute(table, 10)


@pytest.mark.parametrize("attributes, stays", [
    ('title="the hidden gem"', True), ('data-id="share-12"', True), ('data-role="comment"', True), ("title='class=ad'", True),
    ('data-hidden="hidden"', True), ('data-style="display: none"', True), ("title=\"say 'id=menu'\" class=lead", True), ('aria-hidden="false"', True),
    ("hidden", False), ("HIDDEN=hidden", False), ("id=x hidden/", False), ('aria-hidden = "true"', False), ("aria-hidden=true", False),
    ("style='color: red; display:none'", False), ('style="display:none !important"', False), ('title="x"class="share"', False), ("ROLE=comment", False)])
def test_only_values_of_the_named_attributes_set_a_block_apart(attributes, stays):
    page = f"<article><p>{LONG}<p {attributes}>Inside.</p><div {attributes}>More.</div><p>End.</article>"
    assert main_text(page) == f"{LONG}\n\n" + "Inside.\n\nMore.\n\n" * stays + "End."


def test_full_licence_texts(spark):
    """Alone, rewrapped to one line, and amid other text without paragraphs of its own."""
    texts = full_texts()
    table = []
    for i, (_, text) in enumerate(texts):
        plain = " ".join(text.split())
        table += [(i, text), (100 + i, plain), (200 + i, f"{prose(300, i)} {plain} {prose(300, 50 + i)}")]
    got = {r.doc_id: (r.n_notices, r.licences, r.best) for r in scan_licences(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert {d: licences for d, (_, licences, _) in got.items()} == {d: [texts[d % 100][0]] for d in got}
    assert all(best >= 0.8 for _, _, best in got.values())  # a line of text and prose counts as a whole if that is enough


def test_notices_within_longer_lines(spark):
    inside = f"{prose(40, 1)} Licensed under CC BY 4.0. {prose(40, 2)} Released under\nthe MIT License. {prose(9, 3)}"
    table = [(1, inside), (2, "Released under the MIT License. " + prose(30, 1)), (3, f"{prose(30, 1)}\nLicensed under CC BY 4.0.\n{prose(30, 2)}")]
    got = {r.doc_id: (r.n_notices, r.licences, r.best) for r in scan_licences(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got == {1: (2, ["CC-BY-4.0", "MIT"], 1.0), 2: (1, ["MIT"], 1.0), 3: (1, ["CC-BY-4.0"], 1.0)}


def test_best_passage_against_all_passages(spark):
    """One-line texts of few words, so that passages have repeats and ties: the best one of all is found, and none that is not there."""
    pick, template = random.Random(5), "a b c a d e b a c"
    pairs = {tuple(template.split()[i: i + 2]) for i in range(8)}
    table = [(i, " ".join(pick.choice("abcdexyz") for _ in range(pick.randint(1, 40)))) for i in range(150)]
    table += [(1000 + i, f"{prose(5, i)} {' '.join(w for w in template.split() if pick.random() < 0.95)} {prose(5, 9 + i)}") for i in range(50)]
    want = {}
    for i, text in table:
        words = text.split()
        seen = [list(zip(words[a:b], words[a + 1: b])) for a in range(len(words)) for b in range(a + 2, len(words) + 1)]
        want[i] = max((2 * len(pairs & set(s)) / (len(set(s)) + len(pairs)) for s in seen), default=0)
    got = scan_licences(spark.createDataFrame(table, "doc_id long, text string"), [("X", template)], 0.7).collect()
    assert sum(x >= 0.7 for x in want.values()) > 20
    for r in got:
        whole = table[[d for d, _ in table].index(r.doc_id)][1].split()
        mine = set(zip(whole, whole[1:]))
        line = 2 * len(pairs & mine) / (len(mine) + len(pairs))
        if line < 0.7:  # else the line counts before passages do
            assert r.best == (want[r.doc_id] if want[r.doc_id] >= 0.7 else None)
