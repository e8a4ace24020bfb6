"""Filter audit, page extraction and conversation repair against brute force."""

import hashlib
import html
import itertools
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from logloom.llm import dom, grammar, interactions, repairs, wrappers
from logloom.llm.common import table
from logloom.llm.queries import QUERIES
from tests.conftest import TESTDATA
from tests.llm.helpers import AWKWARD, documents

# --- filter interactions


def fails(doc_id, text, texts):
    raw = (text or "").encode()
    words = raw.split()
    return "".join(c for c, f in zip("ABCDE", (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words),
        100 * sum(65 <= b <= 90 for b in raw) > 5 * len(text or ""), bool(set(text or "") & set("#$%&*|")),
        doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t in texts))) if f)


def audited(rows, labels):
    texts = [(r[0], r[1]) for r in rows]
    want = {}
    for part in {r[3] or "" for r in rows}:
        own = [(fails(r[0], r[1], texts), labels.get(r[0], (0, 0))) for r in rows if (r[3] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for f, _ in own:
                first = next((c for c in order if c in f), None)
                if first:
                    shapley[first] += 1
        for order in itertools.permutations("ABCDE"):
            for step, c in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [(f, m) for f, m in own if c in f and not before & set(f)]
                want[part, "".join(order), step] = (
                    sum(not (before | {c}) & set(f) for f, _ in own), len(here),
                    sum(c in f and bool(before & set(f)) for f, _ in own), sum(f == c for f, _ in own),
                    sum(m[0] for _, m in here), sum(m[1] for _, m in here), shapley[c])
    return want


@pytest.mark.parametrize("clashing", [False, True])
def test_audit_of_awkward_texts(spark, clashing, monkeypatch):
    monkeypatch.setattr(interactions, "SHARD_WORDS", 3)  # many shards
    rows = [*AWKWARD, (9, "alpha beta gamma delta " * 30, "en", "a"), (10, "A B C $ " + "word " * 60, "en", "b"),
            (11, "", "en", "c")]
    labels = [(1, 1, 0), (1, 0, 1), (9, 1, 1), (None, 1, 1), (10, None, None), (99, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = interactions.audit(documents(spark, rows, clashing), marks).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == audited(rows, {1: (1, 1), 9: (1, 1)})
    assert len(got) == 600 * len({r[3] or "" for r in rows})


def test_audit_of_empty_tables(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions.audit(documents(spark, []), marks).count() == 0
    rows = interactions.audit(documents(spark, AWKWARD[:3]), marks).collect()
    assert rows and not any(r.good_lost or r.toxic_lost for r in rows)


def test_matrix_has_one_column_for_a_word(spark, monkeypatch):
    monkeypatch.setattr(interactions, "SHARD_ENTRIES", 4)
    docs = documents(spark, [(i, f"same Same w{i % 7} w{i % 3} same", "en", "a") for i in range(40)]).repartition(5)
    name = {}
    rows = interactions.matrix(docs).collect()
    assert len(rows) > 10
    for r in rows:
        for word, column in zip(r.vocabulary, r["columns"]):
            assert name.setdefault(column, bytes(word)) == bytes(word)
        for n, fact in enumerate(r.facts):
            entries = range(r.indptr[n], r.indptr[n + 1])
            got = {name[r["columns"][r.places[e]]]: r["counts"][e] for e in entries}
            text = f"same Same w{fact.doc_id % 7} w{fact.doc_id % 3} same".encode().split()
            assert got == {w: text.count(w) for w in text}
    assert len(set(name.values())) == len(name) == 9


def test_a_code_that_two_words_share_is_given_up(spark, monkeypatch):
    docs, real = documents(spark, [(1, "one two", "en", "a"), (2, "two three", "en", "a")]), interactions.code
    monkeypatch.setattr(interactions, "code", lambda w, seed: real(w, 1) % 2 if seed == 0 else real(w, seed))
    (row,) = interactions.matrix(docs.coalesce(1)).collect()
    assert len(set(row["columns"])) == 3


# --- pages


class Articles(HTMLParser):
    """Blocks of the article of the table's simple pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.on |= tag == "article"
        self.blocks += [""] if tag in ("p", "h1") else []
        self.blocks[-1] += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        self.on &= tag != "article"
        self.blocks += [""] if tag in ("p", "h1") else []

    def handle_data(self, data):
        if self.on:
            self.blocks[-1] += data


def test_pages_of_the_table(spark):
    got = {r.page_id: r for r in QUERIES["op12_html_main_text"](spark, TESTDATA).collect()}
    for page in table(spark, TESTDATA, "pages").collect():
        parser = Articles()
        parser.feed(page.html)
        parser.close()
        blocks = [" ".join(b.split()) for b in parser.blocks]
        assert got[page.page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


PLAIN = """<html><head><title>T</title></head><body><table><tr><td>The same top line<td>Home of news</table>
<div><p>Story %d begins &amp; goes on<br>here<p>Then part %d</div><p>Written by the same people</body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string")


def test_wrapper_of_a_host(spark):
    rows = [(i, f"http://A.example/{i}", PLAIN % (i, i), "x", "y") for i in range(9)]
    # too few pages for a wrapper; copies of one marked article; no host
    rows += [(20 + i, f"http://few.example/{i}", PLAIN % (i, i), "x", "y") for i in range(3)]
    copy = "<body><nav>m</nav><article><p>One story<p>told by all</article><footer>f</footer>"
    rows += [(30 + i, f"http://copies.example/{i}", copy, "x", "y") for i in range(8)]
    rows += [(40 + i, None, PLAIN % (i, i), "x", "y") for i in range(8)]
    got = {r.page_id: r for r in wrappers.extracted(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in range(9):
        assert got[i].text == f"Story {i} begins & goes on here\n\nThen part {i}"
        assert got[i].n_template == 3
    assert got[20].text.startswith("The same top line\n\nHome of news\n\nStory 0") and got[40].n_template == 0
    assert all(got[30 + i].text == "One story\n\ntold by all" for i in range(8))


def test_line_that_all_articles_of_a_host_repeat(spark):
    page = "<article><h1>Head {0}</h1><p>Long text about subject {0} and more of it<p>Share this</article>"
    rows = [(i, f"https://u:p@b.example:80/{i}?q=1", page.format(i), "", "") for i in range(6)]
    got = {r.page_id: r.text for r in wrappers.extracted(pages(spark, rows)).collect()}
    assert got[3] == "Head 3\n\nLong text about subject 3 and more of it"


def test_awkward_pages(spark):
    cases = [
        (None, ""), ("", ""), ("no markup &lt; at all", "no markup < at all"), ("<p>cut &am", "cut &am"),
        ("<article><p>a<!-- x <p>y", "a"), ("<article>a<script>if (1 < 2) '<p>'</script>b<p", "ab"),
        ("<body class='has-sidebar'><div class=side-bar>s</div><div class=sidebar>t</div><p>u</p>", "s\n\nu"),
        ("<main><form>f</form><section id=comments><p>c</section><p>m<aside>n</aside></main>", "m"),
        ("<article class='post comments-open'>x<article class=comment>y</article></article>", "x"),
        ("<div class=cookie-notice>k</div><header><h1>h</h1></header><ul><li><a>one</a><li><a>two</a></ul>z", "z"),
        ("<form><article>inside</article></form>", "inside"), ("<article></article><p>out", "out"),
        ("<article><header><h1>h</h1></header><p>1<table><tr><td>2<td>3</table></article>", "h\n\n1\n\n2\n\n3"),
        ("<b>x</b> <i>y</i>&nbsp;\n z<div>&#233;&eacute;</div>", "x y z\n\néé"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000 + "after", "deep\n\nafter"),
        ("<article>" + "<p>w " * 30_000, "\n\n".join(["w"] * 30_000)),
    ]
    rows = [(i % 12, None if i % 2 else "http://h.example/", c[0], "t", "h") for i, c in enumerate(cases)]
    got = wrappers.extracted(pages(spark, rows)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == sorted(
        (i % 12, c[1], len(c[1])) for i, c in enumerate(cases))
    assert wrappers.extracted(pages(spark, [])).collect() == []


def test_matching_is_the_largest():
    def size(n):
        return 1 + (n.text is not None) + sum(size(k) for k in n.kids)

    page = "<ul><li>a<li>b<ol><li>x</ol><li>c</ul><p>t"
    one = dom.tree(page)
    assert dom.match(one, dom.tree(page))[0] == size(one)
    dom.numbered(one)
    _, pairs = dom.match(one, dom.tree("<p>new<ul><li>a<li>more<li>q<ol><li>x</ol><li>c</ul>"))
    assert {(a.text, b.text) for a, b in pairs} >= {("a", "a"), ("x", "x"), ("c", "c")}


def matched(one, other):
    score, pairs = dom.match(dom.tree(one), dom.tree(other))
    return score, [(a.text, b.text) for a, b in pairs]


def test_long_lists_of_siblings_match_like_short_ones(monkeypatch):
    def page(*words):
        return "".join(f"<p>{w}" for w in words)

    many = [f"w{n}" for n in range(700)]
    assert len(many) ** 2 > dom.CELLS
    score, pairs = matched(page("moved", *many), page(*many, "moved"))
    assert score == 1 + 3 * len(many) and sorted(pairs) == sorted(zip(many, many))

    rng = np.random.default_rng(8)

    def grown(depth):
        kinds = ["p", "div", "section", "li"]
        inner = "".join(grown(depth - 1) for _ in range(rng.integers(1, 7))) if depth else ""
        kind, word = kinds[rng.integers(4)], "abc"[rng.integers(3)]
        return f"<{kind}>{word}</{kind}>" if not depth or rng.random() < 0.3 else f"<{kind}>{inner}</{kind}>{word}"

    for _ in range(150):
        one, other = ("".join(grown(2) for _ in range(rng.integers(1, 9))) for _ in range(2))
        whole = matched(one, other)
        with monkeypatch.context() as m:
            m.setattr(dom, "CELLS", 0)
            assert matched(one, other) == whole



# --- conversations

LEGAL = re.compile("(s?(ua)+)?")


def cheapest(turns):
    """Least (cost, audit) and the repaired turns by trying every edit; `turns` are (role, text, fault)."""
    best = None

    def extend(i, cost, audit, out, inserted):
        nonlocal best
        initials = "".join(r[:1] for r, _ in out)
        if best and cost > best[0] or not re.fullmatch("s?(ua)*u?", initials):
            return
        if i == len(turns) and LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, out
        if inserted < 2:
            for r in ("user", "assistant"):
                extend(i, cost + 5, audit + "I", [*out, (r, "")], inserted + 1)
        if i < len(turns):
            role, text, fault = turns[i]
            extend(i + 1, cost + 2, audit + "D", out, 0)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                extend(i + 1, cost + more, audit + "K", [*out, (role, text)], 0)
                for r in ("user", "assistant"):
                    extend(i + 1, cost + 1 + more, audit + "R", [*out, (r, text)], 0)

    extend(0, 0, "", [], 0)
    return best


def stepwise(turns):
    """The same by a table over the states of the pattern, for long conversations."""
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    now = {"": (0, "", ())}
    def insert(now):
        for _ in range(3):
            for s, (c, a, o) in list(now.items()):
                for r in ("user", "assistant"):
                    t = go.get((s, r[0]))
                    if t is not None:
                        now[t] = min(now.get(t, (9e9,)), (c + 5, a + "I", (o, (r, ""))))
        return now
    for role, text, fault in turns:
        new = {}
        for s, (c, a, o) in insert(dict(now)).items():
            ways = [(s, 2, "D", o)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                ways += [(go.get((s, r[:1])), more + (e == "R"), e, (o, (r, text)))
                         for r, e in ((role, "K"), ("user", "R"), ("assistant", "R"))]
            for t, d, e, p in ways:
                if t is not None:
                    new[t] = min(new.get(t, (9e9,)), (c + d, a + e, p))
        now = new
    cost, audit, out = min(v for s, v in insert(dict(now)).items() if s in ("", "a"))
    lines = []
    while out:
        out, line = out
        lines.append(line)
    return cost, audit, lines[::-1]


def order(turn):
    return (turn is not None, turn or 0)


def faults(rows):
    """(role, text, fault) in order; rows are (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in sorted(rows, key=lambda r: (order(r[0]), r[1].encode(), r[2].encode())):
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                 else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def summary(rows, solve):
    told = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, out = solve(told)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(told, told[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == n for _, _, f in told) for n in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def shown(found, ids):
    rows = repairs.all_conversations(ids, found).collect()
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_cheapest_edits_by_trying_all():
    rng = np.random.default_rng(5)
    for _ in range(400):
        turns = [(str(rng.choice(["user", "assistant", "system", "tool", " ", "usher"])), str(n),
                  str(rng.choice(["", "", "", "blank", "truncated", "duplicate"]))) for n in range(rng.integers(0, 6))]
        want = cheapest(turns)
        assert stepwise(turns)[:2] == want[:2] and stepwise(turns)[2] == want[2]
        told = [(r[:1], f in ("blank", "duplicate"), f == "truncated") for r, _, f in turns]
        for cut in (len(told) or 1, 1, 2):  # whole, and in segments with every entry
            parts = [turns[i : i + cut] for i in range(0, len(turns), cut)]
            moves = [[m for e in grammar.ENTRIES for m in grammar.transfers(e, told[i : i + cut])]
                     for i in range(0, len(turns), cut)]
            cost, chosen = grammar.joined(moves)
            if not turns:
                assert (cost, chosen) == (0, [])
                continue
            assert (cost, "".join(a for _, a in chosen)) == want[:2]
            out = [t[:2] for (e, a), p in zip(chosen, parts) for t in grammar.apply(e, a, [t[:2] for t in p])]
            assert out == want[2]


def test_repair_of_the_table(spark):
    rows = {}
    for r in table(spark, TESTDATA, "conversations").collect():
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        mine = rows.setdefault(r.conv_id, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", r.text) if kind == 2 else r.text
        mine += [(r.turn, "user" if kind == 4 else r.role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, TESTDATA).collect()}
    assert got == {c: summary(v, stepwise) for c, v in rows.items()}


@pytest.mark.parametrize("segment", [2, 5, 2000])
def test_repair_of_awkward_conversations(spark, segment, monkeypatch):
    monkeypatch.setattr(repairs, "SEGMENT", segment)
    monkeypatch.setattr(repairs, "TURNS_PER_TASK", 40)
    rng = np.random.default_rng(segment)
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 3, "assistant", "So?"), (2, None, None, None),
            (2, None, "user", "x."), (2, None, "assistant", "y \n"), (None, 1, "user", "u!"), (None, 2, "tool", "t."),
            (3, 5, "system", "s."), (4, 1, "", "e."), (5, 1, "user", "end.\x0b "), (5, 2, "assistant", ".　")]
    rows += [(6, n, str(rng.choice(["user", "assistant", "system"])), str(rng.choice(["a.", "b", "", f"c{n}!", "d."])))
             for n in range(300)]
    rows += [(7, 1, "user", "copy.")] * 50 + [(7, 2, "assistant", "ok.")]
    rows += [(8, n, "assistant" if n % 2 else "user", f"t{n}.") for n in range(100)]
    table_of = spark.createDataFrame([(*r, "x") for r in rows],
                                     "conv_id long, turn long, role string, text string, place string")
    want = {}
    for c in {r[0] for r in rows}:
        want[c] = summary([(t, " " if r is None else r, " " if x is None else x) for i, t, r, x in rows if i == c],
                          stepwise)
    gone = spark.createDataFrame([(99,)], "conv_id long").unionByName(table_of.select("conv_id"))
    got = shown(repairs.repair(table_of), gone)
    assert got.pop(99) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want


def test_repair_of_no_conversation(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = repairs.repair(none)
    assert repairs.all_conversations(none, found).collect() == [] == found.segments.collect()


def test_damage_of_nulls(spark):
    rows = [(n, t, r, x) for n in range(60) for t, r, x in ((None, None, None), (1, "system", "a.b!"))]
    rows += [(None, n, "user", "q?") for n in range(20)]
    got = repairs.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_entities_as_the_library_decodes_them():
    for raw in ("&amp", "&lt;b&gt;", "&#x41;&#0;", "&notit;", "&copy 1", "a & b"):
        assert [x.text for x in dom.article(dom.tree(f"<p>{raw}"))[0]] == [" ".join(html.unescape(raw).split())]
