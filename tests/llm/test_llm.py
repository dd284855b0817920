"""Every operator against brute force or literals, and on tables with nulls, empties, ties, repeats, long texts and clashing columns."""

import itertools
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
from cadastra.llm import ball_tree, exact_dedup, html_text, line_dedup, mixing, ngram_join, pii, quality, queries, sentencepiece_trie, url_filter
from cadastra.llm.shared import Scratch, components, forest, united

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, size long, key string, th long, root long, node long, bands string, rest string, kept string, weight double"


def odd_rows():
    texts = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, LONG), (6, LONG + "!"), (None, "null id text one"), (None, "null id text one"), (None, None), (7, "  \n\t\n"), (8, "x"), (9, "A B C D E F"), (10, "line one of it\nline one of it\n")]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, 1, 2, "k", 3, 4, 5, "b", "r", "no", 0.5) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, name):
    compare.same(queries.queries()[name](spark, sf), queries.oracle_sql()[name], sf)


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long"), Scratch(spark, "t")).collect()}
    assert got == {x: find(x) for x in root if any(x in p for p in pairs if p[0] != p[1])}
    for most in (1 << 20, 10):  # joined in one task, and by the star steps
        edges = spark.createDataFrame(pairs, "u long, v long").repartition(5)
        assert {r.node: r.root for r in united(edges, Scratch(spark, "t"), most).collect()} == {x: r for x, r in got.items() if x != r}


# -- 4 exact dedup


def test_exact_dedup_odd(spark, odd, empty):
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == 14 and sum(r.kept for r in got) == len({r[1] or "" for r in odd_rows()})
    same = [r for r in got if r.group_size == 3 and r.keep_id == 2]
    assert len(same) == 3 and sum(r.kept for r in same) == 1
    assert {(r.doc_id, r.keep_id) for r in got if r.doc_id in (3, 4)} == {(3, 4), (4, 4)}
    assert {r.keep_id for r in got if r.doc_id in (5, 6)} == {5, 6}
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_levels(spark):
    base = "z" * 5000
    texts = [base, base, base[:-1] + "y", base[:32], base[:32], base[:33], base[:288], base[:288], base[:287] + "q", base[:320]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == {i: (max(j for j, u in enumerate(texts) if u == t), texts.count(t)) for i, t in enumerate(texts)}


# -- 9 mixing


def test_mixing_odd(spark, odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == 14 and all(0 <= r.taken <= 3 * r.size for r in got)
    for s in {r.source for r in got}:
        rows = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(odd.repartition(3)).collect()))
    assert mixing.mix(empty).count() == 0


def test_targets_stop_at_caps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 30 and got["c"] == 15 and got[None] == 0 and got["b"] == pytest.approx(970)


def test_emit(spark):
    df = spark.createDataFrame([(1, " one two  three\nfour", "a", 20), (2, "five six", "a", 8), (3, "x " * 50, "b", 100), (4, None, "b", 0)], "doc_id long, text string, source string, n_chars long")
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    words = {}
    for r in mixing.emit(df, ["doc_id", "text", "n_chars"]).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
        assert r.n_chars in (len(r.text), 20, 8, 100)
    assert words == {k: v for k, v in taken.items() if v}


# -- 6 URLs


def test_url_equivalence(spark):
    pages = [
        (1, "http://Bad.com/en/x", ""), (2, "https://alias.net/a", '<link rel="canonical" href="http://bad.com/en/x">'), (3, "http://third.net/b?q", "<meta http-equiv=refresh content='0; url=https://alias.net/a#t'>"),
        (4, "http://ok.example.com/en/7z", '<link href="http://bad.com/en/q" rel=canonical>'), (5, "http://free.net/x", ""), (6, None, None), (7, "no url", "x"), (8, "http://free.net/x?again", ""),
        (9, "http://u.net/1", "<link rel='canonical' href='/2'>"), (None, "http://bad.com/en/", None), (10, "http://mixed.net/", '<link rel="canonical" href="http://ok.example.com/en/7z">'),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.url_filter(df, url_filter.rules_table(spark, url_filter.RULES)).collect()}
    verdicts = {k: r.verdict for k, r in got.items()}
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow", None: "block", 10: "allow"}
    assert (got[1].host, got[1].path, got[1].rule) == ("bad.com", "/en/x", "com/en/") and got[4].rule == "example.com/en/7" and got[2].rule is None
    assert (got[6].host, got[6].path) == ("", "")
    edges = spark.createDataFrame([("http://free.net/x", "http://bad.com/en/x")], "url string, target string")
    again = {r.page_id: r.verdict for r in url_filter.url_filter(df, url_filter.rules_table(spark, url_filter.RULES), edges).collect()}
    assert again[5] == again[8] == "block"
    assert url_filter.url_filter(df.limit(0), url_filter.rules_table(spark, url_filter.RULES)).count() == 0


def test_url_links(spark):
    """Every link of a page, quoted refresh URLs, and targets relative to the page's path."""
    cases = [
        ("http://a.net/d/e/f", '<link rel=canonical href="http://x.net/1"><link rel=canonical href=http://x.net/2>', {"http://x.net/1", "http://x.net/2"}),
        ("http://a.net/d/e/f", """<meta http-equiv="refresh" content="0;url='http://x.net/q'">""", {"http://x.net/q"}),
        ("http://a.net/d/e/f", """<meta http-equiv=refresh content='0; URL="http://x.net/q;v"'><meta http-equiv=refresh content=5;url=/r>""", {"http://x.net/q;v", "http://a.net/r"}),
        ("http://A.net/d/e/f?x=/y/", '<link rel=canonical href="page2.html">', {"http://a.net/d/e/page2.html"}),
        ("http://a.net/d/e/f", "<link rel=canonical href='../x'><link rel=canonical href='../../../y/./z/..'>", {"http://a.net/d/x", "http://a.net/y/"}),
        ("http://a.net/d/e/f", "<link rel=canonical href='?p=1'><link rel=canonical href='mailto:me'>", {"http://a.net/d/e/f"}),
        ("http://a.net", "<link rel=canonical href=g?next=http://x.net/>", {"http://a.net/g"}),
        ("http://a.net/d/e/f", "<link rel=canonical href='//x.net/z'>", {"http://x.net/z"}),
    ]
    df = spark.createDataFrame([(f"{u}#{i}", h) for i, (u, h, _) in enumerate(cases)], "url string, html string")
    got = {}
    for r in url_filter.page_links(df).collect():
        got.setdefault(int(r.url.split("#")[1]), set()).add(r.target)
    assert got == {i: t for i, (_, _, t) in enumerate(cases)}
    pages = [(1, "http://bad.com/en/x", ""), (2, "http://bad.com/en/y", "<link rel=canonical href='../fr/2'>"), (3, "http://bad.com/fr/2", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.url_filter(df, url_filter.rules_table(spark, url_filter.RULES)).collect()}
    assert got == {1: "block", 2: "block", 3: "block"}


def test_url_classes_brute(spark):
    """Thousands of random redirects among pages and other URLs, with chains, cycles and a hub, against plain union-find."""
    rng = np.random.default_rng(41)
    hosts = ["a.net", "b.com", "c.org", "example.com", "www.example.net", "d.io"]
    paths = ["/en/", "/de/", "/de/8", "/es/", "/en/7", "/x"]
    urls = [f"http://{hosts[i % 6]}{paths[int(rng.integers(0, 6))]}{i}" for i in range(3000)]
    pick = lambda: int(rng.integers(0, 3000))
    edges = [(urls[pick()], urls[pick()]) for _ in range(900)] + [(urls[i], urls[i + 1]) for i in range(200, 260)] + [(urls[2900], urls[k]) for k in range(2901, 2960)]
    links = [(k, urls[k], f"<link rel=canonical href='{urls[pick()]}'>" if rng.random() < 0.2 else None) for k in range(2000)]
    pages = spark.createDataFrame([(*x, "h", "v") for x in links], "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: r for r in url_filter.url_filter(pages, url_filter.rules_table(spark, url_filter.RULES), spark.createDataFrame(edges, "url string, target string")).collect()}

    def rule(u):
        host, path = u.split("//")[1].split("/", 1)
        path = "/" + path
        fit = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, None)

    root = {u: u for u in urls}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges + [(u, h.split("'")[1]) for _, u, h in links if h]:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    rules = {u: rule(u)[0] for u in urls}
    bad = {find(u) for u in urls if rules[u] == "block"} - {find(u) for u in urls if rules[u] == "allow"}
    want = {k: rules[u] or ("block" if find(u) in bad else "allow") for k, u, _ in links}
    assert {k: r.verdict for k, r in got.items()} == want and {k: r.rule for k, r in got.items()} == {k: rule(u)[1] for k, u, _ in links}
    assert sum(v == "block" and not rules[links[k][1]] for k, v in want.items()) > 50


def test_url_long(spark):
    """Very long URLs and rules of equal length."""
    long = "http://h.net/" + "x" * 200_000
    rules = spark.createDataFrame([("block", "h.net", "/ab"), ("allow", "h.net", "/ab"), ("block", "h.net", "/x")], "verdict string, host string, path string")
    df = spark.createDataFrame([(1, long, None), (2, "http://h.net/abc", ""), (3, "http://sub.h.net/ab", "")], "page_id long, url string, html string")
    assert {r.page_id: (r.verdict, len(r.path)) for r in url_filter.url_filter(df, rules).collect()} == {1: ("block", 200_001), 2: ("allow", 4), 3: ("allow", 3)}


# -- 7 n-gram join


def sets(text, words):
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute_components(docs, words, percent):
    s = {i: sets(t, words) for i, t in docs}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(s, 2):
        if s[a] and s[b]:
            k = len(s[a] & s[b])
            if 100 * k >= percent * (len(s[a]) + len(s[b]) - k):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in s}


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_ngram_join_brute(spark, words, percent):
    rng = np.random.default_rng(7)
    docs = []
    for g in range(12):
        base = [f"t{x}" for x in rng.integers(0, 400, int(rng.integers(3, 160)))]
        for _ in range(12):
            w = list(base)
            for _ in range(int(rng.integers(0, 1 + len(w) // 12))):
                w[int(rng.integers(0, len(w)))] = f"e{rng.integers(0, 50)}"
            docs.append((len(docs), " ".join(w)))
    docs += [(len(docs) + k, "the very same short passage again " * 3 + f"tail{k}") for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(spark.createDataFrame(docs, "doc_id long, text string"), words, percent).collect()}
    assert got == brute_components(docs, words, percent)


def test_ngram_join_odd(spark, odd, empty):
    got = ngram_join.ngram_join(odd, 3, 90).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 14 and by[1].component_id == by[2].component_id == by[9].component_id == 1 and by[6].component_id == 5
    assert by[3].n_shingles == by[4].n_shingles == by[7].n_shingles == 0 and by[3].component_id == 3 and by[8].n_shingles == 1
    assert ngram_join.ngram_join(empty).count() == 0


# -- 1 lines


def test_line_dedup_recall(spark):
    rng = np.random.default_rng(11)
    lines = []
    for _ in range(60):
        base = [f"{''.join(chr(97 + x) for x in rng.integers(0, 26, 5))}" for _ in range(int(rng.integers(4, 40)))]
        for _ in range(4):
            w = list(base)
            w[int(rng.integers(0, len(w)))] = "edit" + str(rng.integers(0, 9))
            lines.append(" ".join(w))
    docs = [(i, "\n".join(lines[i * 8 : i * 8 + 8])) for i in range(len(lines) // 8)]
    s = [frozenset(line_dedup.shingles(x).tolist()) for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(lines)), 2):
        if lines[a] == lines[b] or len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = {i for i in range(len(lines)) if find(i) == i}
    got = line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    kept = [x for r in sorted(got, key=lambda r: r.doc_id) for x in r.text.split("\n") if x]
    assert sum(r.n_lines for r in got) == len(lines)
    assert {lines[i] for i in want} <= set(kept)  # one of each class stays
    assert len(kept) - len(want) <= 0.05 * (len(lines) - len(want))  # and nearly all others go


def test_line_dedup_crowded_bands(spark, monkeypatch):
    """Near copies in bands full of templated lines, in many slices: with pivots for one round only, all pairs that share a band are
    decided."""
    monkeypatch.setattr(line_dedup, "STARS", 1.0)
    monkeypatch.setattr(line_dedup, "SLICE", 20)
    monkeypatch.setattr(line_dedup, "LISTED", 6)
    rng = np.random.default_rng(17)
    word = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    frame, lines = " ".join(word(6) for _ in range(20)), []
    for _ in range(240):  # only the template is shared: near copies are the lines with little of their own
        lines.append(f"{frame} {word(int(rng.integers(3, 40)))}")
    raw = np.frombuffer("\n".join(lines).encode(), np.uint8)
    keys = line_dedup.signatures(*line_dedup.normalise(raw, np.array([0, len(raw)])))
    s = [line_dedup.shingles(x) for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(lines)), 2):
        if (keys[a] == keys[b]).any() and line_dedup.similar(s[a], s[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = line_dedup.line_dedup(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.text} == {i for i in range(len(lines)) if find(i) == i}
    assert sum(r.n_dropped for r in got) > 10


def line_classes(lines):
    """Brute force over an index of the rarest shingles: the class of each line under exact Jaccard SIMILARITY, and how many joins it took."""
    sets = [line_dedup.shingles(x) for x in lines]
    _, inv = np.unique(np.concatenate(sets), return_inverse=True)
    df, at = np.bincount(inv), np.r_[0, np.cumsum([len(s) for s in sets])]
    root, posts, joins = list(range(len(lines))), {}, 0

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i in sorted(range(len(lines)), key=lambda i: len(sets[i])):
        mine = inv[at[i] : at[i + 1]]
        rare = mine[np.argsort(df[mine], kind="stable")][: len(mine) - int(np.ceil(0.8 * len(mine))) + 1].tolist() if len(mine) else []
        for j in {j for t in rare for j in posts.get(t, ())}:
            x, y = find(i), find(j)
            if x != y and line_dedup.similar(sets[i], sets[j]):
                root[max(x, y)], joins = min(x, y), joins + 1
        for t in rare:
            posts.setdefault(t, []).append(i)
    return [find(i) for i in range(len(lines))], joins


def normal_lines(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    buf, starts, ends = line_dedup.normalise(raw, np.array([0, len(raw)]))
    whole = buf.tobytes()
    return [whole[a:b] for a, b in zip(starts, ends) if b > a]


def line_recall(df):
    lines = list(dict.fromkeys(x for r in df.collect() for x in normal_lines(r.text)))
    root, joins = line_classes(lines)
    kept = [x for r in line_dedup.line_dedup(df).collect() for x in normal_lines(r.text)]
    assert len(kept) == len(set(kept)) and joins > 50
    assert {root[k] for k, x in enumerate(lines) if x in set(kept)} == set(root)  # every class keeps a line
    return 1 - (len(kept) - len(set(root))) / joins


def test_line_dedup_recall_documents(spark, sf):
    """On whole documents: lines of all classes stay, and at least 0.98 of the joins of exact classes are found."""
    assert line_recall(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")) >= 0.98


def test_line_dedup_recall_dominant(spark):
    """One class of 3000 near copies, and 150 pairs of lines that share most of their text with it."""
    rng = np.random.default_rng(29)
    word = lambda n=6: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    base, lines = [word() for _ in range(24)], []
    for _ in range(3000):
        w = list(base)
        w[int(rng.integers(0, 24))] = word(4)
        lines.append(" ".join(w))
    for _ in range(150):
        tail = [word() for _ in range(9)]
        lines += [" ".join([*base[:20], *tail, word(3)]) for _ in range(2)]
    order = rng.permutation(len(lines))
    df = spark.createDataFrame([(i, "\n".join(lines[k] for k in order[i * 30 : i * 30 + 30])) for i in range(len(lines) // 30)], "doc_id long, text string")
    assert line_recall(df) >= 0.98


def test_line_dedup_slices(monkeypatch):
    """Lines that meet in one band are linked as brute force links them, whether their pairs are listed or met by pivots."""
    import pyarrow as pa

    rng = np.random.default_rng(31)
    word = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    frame = " ".join(word(6) for _ in range(20))
    lines = [f"{frame} {word(int(rng.integers(3, 40)))}" for _ in range(120)] + ["short", "tiny"]
    raw = np.frombuffer("\n".join(lines).encode(), np.uint8)
    keys = line_dedup.signatures(*line_dedup.normalise(raw, np.array([0, len(raw)]))).view(np.int64)
    keys[:, 3] = 7
    sets = [line_dedup.shingles(x) for x in lines]
    maps = line_dedup.parity(sets)
    table = {"band": [7] * len(lines), "slice": [0] * len(lines), "node": list(range(len(lines))), "n": [len(x) for x in sets], "bands": keys.tolist(), "t": lines}
    table = pa.table(table | {f"m{i}": maps[:, i] for i in range(line_dedup.MAPS)})
    want = set()
    for a, b in itertools.combinations(range(len(lines)), 2):
        if not (keys[a, :3] == keys[b, :3]).any() and line_dedup.similar(sets[a], sets[b]):
            want.add((a, b))
    groups = []
    for most in (200, 5):
        monkeypatch.setattr(line_dedup, "LISTED", most)
        us, vs = line_dedup._Met(table).links()
        assert set(zip(us, vs)) <= want
        groups.append(forest(np.array(us), np.array(vs)))
    full = forest(*np.array(sorted(want)).T)
    assert len(full[0]) > 10
    for g in groups:
        assert dict(zip(*map(np.ndarray.tolist, g))) == dict(zip(*map(np.ndarray.tolist, full)))


def plain_bands(line):
    """The bands of one line by the definition, in plain numbers."""
    full, p = (1 << 64) - 1, line_dedup.kernel.P

    def mix(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & full
        h = (h ^ h >> 27) * 0x94D049BB133111EB & full
        return h ^ h >> 31

    low, n = {}, line_dedup.BANDS * line_dedup.ROWS
    for k in range(max(len(line) - line_dedup.Q + 1, 1)):
        h = int.from_bytes(line[k : k + line_dedup.Q], "little") * p & full
        h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 & full
        h ^= h >> 29
        low[h >> 59] = min(h, low.get(h >> 59, full))
    far = [next(d for d in range(n) if (k + d) % n in low) for k in range(n)]
    filled = [low[(k + d) % n] for k, d in enumerate(far)]
    filled = [mix(h + d * p & full) if d else h for h, d in zip(filled, far)]
    keys = []
    for k in range(line_dedup.BANDS):
        key = 0
        for i in range(line_dedup.ROWS):
            key = mix(key * p + filled[i * line_dedup.BANDS + k] + i + 1 & full)
        keys.append(mix(key + (k + 1) * line_dedup.kernel.P_INV & full))
    return keys


def plain_lines(text):
    low = text.encode().lower()
    return [b" ".join(x for x in re.split(rb"[ \t\x0b\x0c\r]+", y) if x) for y in low.split(b"\n")]


def test_line_dedup_candidates(monkeypatch):
    """Lines picked from many documents, in any order and from a repeated row: what comes back of each line is what it has alone, by the
    definition, and the documents of a batch are normalised together, not one by one."""
    import pyarrow as pa

    rng = np.random.default_rng(37)
    parts = ["a", "Bc", "word", "\u00e9t\u00e9", "x" * 9, "longer words of text", " ", "  ", "\t", "\r", "\n", "\n\n", "\n \n"]
    texts = ["".join(rng.choice(parts, int(rng.integers(1, 60))).tolist()) for _ in range(300)] + [" ".join(f"w{k}" for k in range(20000)) + "\nend"]
    plain, rows, want = [plain_lines(t) for t in texts], [], {}
    for k, t in enumerate(texts):
        full = [i for i, x in enumerate(plain[k]) if x]
        lines = [{"line": i, "node": 1000 * k + i, "slices": [i % 3] * line_dedup.BANDS} for i in rng.permutation(full).tolist()[: 1 + k % 4]]
        want |= {x["node"]: (plain[k][x["line"]], x["slices"]) for x in lines}
        rows.append({"dk": k, "th": -k, "text": t, "lines": lines})
    rows = [r for r in rows if r["lines"]]
    schema = pa.schema(
        [("dk", pa.int64()), ("th", pa.int64()), ("text", pa.string()),
         ("lines", pa.list_(pa.struct([("line", pa.int32()), ("node", pa.int64()), ("slices", pa.list_(pa.int32()))])))]
    )
    calls, normalise = [], line_dedup.normalise
    monkeypatch.setattr(line_dedup, "normalise", lambda *a: calls.append(1) or normalise(*a))
    batches = [pa.RecordBatch.from_pylist(x, schema=schema) for x in (rows, rows[:3])]
    got = [x for b in line_dedup._candidate_texts(batches) for x in b.to_pylist()]
    assert sorted(x["node"] for x in got) == sorted(want) and len(want) > 300
    for x in got:
        text, slices = want[x["node"]]
        bands = np.array(x["bands"], np.int64).view(np.uint64).tolist()
        assert x["t"].encode() == text and x["slices"] == slices and bands == plain_bands(text)
        shingles = line_dedup.shingles(text)
        assert x["n"] == len(shingles) and [x[m] for m in line_dedup.SIGNS[1:]] == line_dedup.parity([shingles])[0].tolist()
    assert len(calls) <= 3


def test_line_dedup_lines():
    """Rows side by side in one buffer, with blanks and cut lines at their edges: lines and bands are those of each row alone."""
    rng = np.random.default_rng(41)
    for size in (6, 40, 4000):
        for _ in range(60):
            rows = ["".join(rng.choice(list("aB \t\r\n\x0b") + ["some words "], int(rng.integers(0, size))).tolist()) for _ in range(5)]
            raw = np.frombuffer("".join(rows).encode(), np.uint8)
            buf, starts, ends = line_dedup.normalise(raw, np.r_[0, np.cumsum([len(r) for r in rows])])
            whole, full = buf.tobytes(), ends > starts
            lines = [x for r in rows for x in plain_lines(r)]
            assert [whole[a:b] for a, b in zip(starts, ends)] == lines
            keys = line_dedup.signatures(buf, starts[full], ends[full])
            some = [x for x in lines if x]
            for k in rng.integers(0, len(some), 3).tolist() if some else ():
                assert keys[k].tolist() == plain_bands(some[k])


def test_line_dedup_odd(spark, odd, empty):
    got = line_dedup.line_dedup(odd).collect()
    assert len(got) == 14 and got[0].__fields__[:2] == ["n_lines", "n_dropped"]
    text = {}
    for r in got:
        text.setdefault(r.doc_id, []).append(r.text)
    assert text[1] == ["a b c d e f"] and text[2] == ["", ""] and text[9] == [""] and text[3] == [None] and text[4] == [""]
    assert text[10] == ["line one of it\n"] and text[7] == ["  \n\t\n"] and text[5] == [LONG] and text[6] == [""]
    assert line_dedup.line_dedup(empty).count() == 0


# -- 5 quality


def test_quality_held_out(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)


def test_quality_marginals():
    """Forward-backward against the sum over all label sequences."""
    rng = np.random.default_rng(2)
    lengths = [1, 2, 5, 7]
    rows = np.repeat(np.arange(4), lengths)
    unary, trans = rng.normal(0, 1.5, len(rows)), rng.normal(0, 1, (2, 2))
    p, expected, _ = quality.marginals(unary, rows, trans)
    want, pairs = np.zeros(len(rows)), np.zeros((2, 2))
    for r in range(4):
        at = np.flatnonzero(rows == r)
        every = list(itertools.product((0, 1), repeat=len(at)))
        weight = np.array([np.exp(sum(unary[i] * y for i, y in zip(at, ys)) + sum(trans[a, b] for a, b in itertools.pairwise(ys))) for ys in every])
        for ys, w in zip(every, weight / weight.sum()):
            want[at] += w * np.array(ys)
            for a, b in itertools.pairwise(ys):
                pairs[a, b] += w
    assert np.allclose(p, want) and np.allclose(expected, pairs)


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (10, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(odd, labels).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 for r in got) and all(r.score == 0 for r in got if r.doc_id in (3, 4, 7))
    assert quality.classify(empty, labels).count() == 0
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}


# -- 3 top-k


def test_top_k_shards(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "SHARD", 70)
    monkeypatch.setattr(ball_tree, "BLOCK", 10)
    monkeypatch.setattr(ball_tree, "LEAF", 8)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 8)]) for i in range(400)] + [(400 + i, [0.25] * 8) for i in range(60)]
    rows += [(900, None), (920, [0.1, None] * 4), (940, [float("nan")] * 8), (960, [float("inf")] * 8), (None, [1.0] * 8), (980, [0.5, 0.5]), (1000, [0.25, 1.0]), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ball_tree.top_k(df).collect())
    v = {i: [int(np.floor(64 * np.float64(np.float32(x)))) for x in e] for i, e in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    want = []
    for q in sorted(v):
        if q % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q and len(v[c]) == len(v[q]))[:20]
            want += [(q, k + 1, c, -x) for k, (x, c) in enumerate(s)]
    assert got == sorted(want)
    assert ball_tree.top_k(df.limit(0)).count() == 0


def test_top_k_tree(monkeypatch):
    """A block of queries through a tree of many small leaves, with floors, ties and own rows, against all scores."""
    monkeypatch.setattr(ball_tree, "LEAF", 4)
    rng = np.random.default_rng(23)
    x = np.floor(rng.normal(0, 4, (300, 3)))
    ids = rng.permutation(300)
    tree = ball_tree.BallTree(x, ids)
    q, own = x[:40], ids[:40]
    scores = q @ x.T
    for floor in (np.full(40, -np.inf), np.sort(scores, axis=1)[:, -30]):
        s, n = tree.search(q, own, 7, floor)
        for r in range(40):
            want = sorted((-scores[r, c], ids[c]) for c in range(300) if ids[c] != own[r])[:7]
            assert [(-a, b) for a, b in zip(s[r], n[r]) if a > -np.inf] == [w for w in want if -w[0] >= floor[r]]


def test_top_k_odd(spark):
    """Vectors of length 0, scores beyond 53 bits, scores beyond 63 bits, clashing columns."""
    rows = [(i, [], 1, 2, "x") for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query_id long, rank int, shard string")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ball_tree.top_k(df).collect())
    assert got == sorted((q, k + 1, c, 0) for q in range(0, 600, 20) for k, c in enumerate([c for c in range(25) if c != q][:20]))
    big = [(i, [float(i) * 2.0**18 + 0.5, 1.0]) for i in range(1, 60)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ball_tree.top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect())
    v = {i: [int(64 * a) for a in x] for i, x in big}
    want = [(q, k + 1, c, -s) for q in (20, 40) for k, (s, c) in enumerate(sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q)[:20])]
    assert got == want
    with pytest.raises(ValueError):
        ball_tree.top_k(spark.createDataFrame([(20, [2.0**40]), (1, [1.0])], "vec_id long, embedding array<double>"))


def test_top_k_shared_ids(spark, monkeypatch):
    """Rows that share an id but not a vector are all candidates."""
    monkeypatch.setattr(ball_tree, "SHARD", 30)
    rows = [(i, [float(i % 7), 1.0]) for i in range(1, 100)] + [(i, [float(i % 5 + 7), 2.0]) for i in range(1, 100, 3)] + [(20, [-3.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = []
    for q in range(20, 100, 20):
        s = sorted((-sum(int(64 * a) * int(64 * b) for a, b in zip(x, y)), c) for i, x in rows if i == q for c, y in rows if c != q)[:20]
        want += [(q, k + 1, c, -x) for k, (x, c) in enumerate(s)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ball_tree.top_k(df).collect()) == want


# -- 8 HTML


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a<p>b<br>c", "a\n\nb\nc"),
        ("<ul><li>x<li>y<ol start=3><li>p<li>q</ol></ul>", "- x\n- y\n\n  3. p\n  4. q"),
        ("<table><tr><th>Name<th>Q<tr><td>Apple<td>10</table>", "Name   Q\nApple  10"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("a<script>x</script><style>.h{display:none}</style><b class=h>no</b><i hidden>no</i><u style='visibility:hidden'>n<s style='visibility:visible'>yes</s></u>", "ayes"),
        ("<pre>\n a\n  b</pre>", " a\n  b"),
        ("1 &lt; 2 &amp; <3 <!-- c --> &nbsp;x", "1 < 2 & <3  x"),
        ("<head><title>t</title></head><body>x  \n y</body>", "x y"),
        ("", ""),
        (None, None),
        ("<a href='never closed", ""),
    ],
)
def test_html(page, text):
    assert html_text.render(page) == text


DEEP = "<div>" * 300


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p title=don't>rest of page</p><p>more</p>", "rest of page\n\nmore"),
        ("""<a href="x"">text</a><b class="y">z</b>""", "textz"),
        ("""<i a"b>one</i> <i c"d>two</i>""", "one two"),
        ("<i title='a>b' hidden>no</i><i x= '>' =z>yes</i>", "yes"),
        ("a</é>b<!-->c<!-- x --!>d", "abcd"),
        ("<table><tbody>in body<tr>in row<td>cell</table>", "in bodyin row\ncell"),
        ("<div>" * 300 + "a<b hidden>no<u>no</u></b>b" + "</div>" * 300 + "<p>after", "a\nb\n\nafter"),
        (DEEP + "<b style='visibility:hidden'>no<u>no</u><s style='visibility:visible'>yes</s></b>", "yes"),
        ("<section hidden>" + DEEP + "<section>x</section>no</section><p>yes", "yes"),
        (DEEP + "a <b>b <i>c</i> d</b> e", "a\nb c d e"),
        (DEEP + "<details>no<summary>yes<b>!</b></summary><p>no</details>z", "yes\n!z"),
    ],
)
def test_html_tokenizer(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p>one <a href=foo">two</a> three <b>four</b>', "one two three four"),
        ("<a title=don't href=x>hello</a> world", "hello world"),
        ("<style>@media print{.nav{display:none}}</style><p class=nav>yes", "yes"),
        ("<style>@media screen and (min-width:9px){.nav{display:none}} .x{display:none}</style><p class=nav>no<p class=x>no<p>yes", "yes"),
        ("<style>@font-face{src:x} @media print{p{display:none} .q{display:none}} /* .y{display:none} */ i{display:none}</style><p class=y>yes<i>no</i>", "yes"),
        ("<style media=print>p{display:none}</style><p>yes", "yes"),
        ("<style>.h{display:none}</style><p class=h style='display:block'>yes", "yes"),
        ("<style>.h{display:none!important}</style><p class=h style='display:block'>no</p>yes", "yes"),
        ("<style>#a{display:block} p.h.k{display:none}</style><p id=a class='h k'>yes<p class='k h'>no", "yes"),
        ("<style>p{display:none} p{display:block} p i{display:none} a>b, u{display:none}</style><p>y<i>e</i>s<u>no</u>", "yes"),
        ("<p hidden style='display:block'>yes<p hidden>no", "yes"),
        ("<div>" * 250 + "<b hidden>no</b>yes", "yes"),
    ],
)
def test_html_cascade(page, text):
    assert html_text.render(page) == text


def test_html_odd(spark, sf):
    deep = "<div>" * 4000 + "x" + "</div>" * 4000
    df = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (2, "", "u"), (3, deep, "u"), (None, "<p>" * 5000 + "y", "u"), (4, "<" * 20000, "u")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got[1] is None and got[2] == "" and got[3] == "x" and got[None] == "y" and len(got[4]) == 20000
    assert html_text.extract(df.limit(0)).count() == 0
    words = {r.page_id: r for r in html_text.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for p in spark.read.parquet(f"{sf}/pages.parquet").collect():  # all text outside of tags that never show
        body = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ", p.html)
        import html

        assert sorted(re.sub(r"\s+", "", html.unescape(body))) == sorted(re.sub(r"\s+", "", re.sub(r"(?m)^ *- ", "", words[p.page_id].text)))


# -- 2 personal data


def luhn(s):
    return sum((int(c) * 2 - 9 * (int(c) > 4)) if k % 2 else int(c) for k, c in enumerate(reversed(s))) % 10 == 0


def test_pii(spark, odd, empty):
    texts = [
        "+1 (499) 555-6503 und.34@mail7.example.com 233.254.104.120 4644348398010899 9807915762804490",
        "again +1 (499) 555-6503, 4644348398010899; 4111 1111 1111 1111 DE89370400440532013000 2024-02-29 29/02/2024 31/02/2024 666-01-0001",
        "version 2.0. 300.1.1.1 1.2.3.4.5 12345 und so weiter",
        'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r for r in pii.pseudonymise(df, 'key').orderBy("doc_id").collect()]
    assert [r.n_found for r in got] == [4, 6, 0, 1] and got[2].text == texts[2]
    a, b = got[0].text, got[1].text
    form = lambda t: re.sub("[a-z0-9]", "9", re.sub(r"([0-9]+\.){3}[0-9]+", "ip", t))
    assert form(a) == form(texts[0])
    phone, card = re.search(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", a)[0], re.findall("[0-9]{16}", a)
    assert phone in b and card[0] in b and luhn(card[0]) and card[1] == "9807915762804490" and "31/02/2024" in b and "666-01-0001" in b
    iban = re.search(r"DE[0-9]{20}", b)[0]
    assert int(iban[4:] + "1314" + iban[2:4]) % 97 == 1 and iban != "DE89370400440532013000"
    assert luhn(re.search(r"[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}", b)[0].replace(" ", ""))
    iso, de = re.search(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", b)[0], re.findall(r"[0-9]{2}/[0-9]{2}/[0-9]{4}", b)[0]
    assert iso.split("-") == de.split("/")[::-1]
    assert re.search('"[0-9a-f]{40}"', got[3].text) and got[3].text != texts[3]
    assert pii.pseudonymise(df, key="other").orderBy("doc_id").first().text != a
    assert [r.text for r in pii.pseudonymise(odd, 'key').collect()] == [r[1] for r in odd_rows()] and pii.pseudonymise(empty, 'key').count() == 0


def test_pii_parts(spark):
    """Valid numbers before further groups or words, and dates with the month first."""
    card, iban = "4111 1111 1111 1111", "ES9121000418450200051332"
    texts = [f"{card} 12/25", f"{card} 123", f"{card} 12 25", f"{iban} USD", "ES91 2100 0418 4502 0005 1332 PAID", f"{iban} {card}", "XX82 1234 5678 9012 3456 PAID", "12/25/2020", "13/13/2020", "+49 30 1234 5678 9999 9999"]
    inside = pii.pseudonymise(spark.createDataFrame([(1, f"in 2024 {card} 12 25")], "doc_id long, text string"), "key").first()
    assert inside.n_found == 1 and re.fullmatch(r"in 2024 [0-9 ]{19} 12 25", inside.text) and card not in inside.text
    valid = next(f"XX{k:02d} 1234 5678 9012 3456" for k in range(2, 99) if int(f"12345678901234563333{k:02d}") % 97 == 1)
    texts[6] = f"{valid} PAID"
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.pseudonymise(df, 'key').orderBy("doc_id").collect()
    assert [r.n_found for r in got] == [1, 1, 1, 1, 1, 2, 1, 1, 0, 1]
    for r, tail in zip(got[:3], (" 12/25", " 123", " 12 25")):
        assert r.text.endswith(tail) and card not in r.text and luhn(r.text[:19].replace(" ", ""))
    for k, tail in ((3, " USD"), (4, " PAID"), (5, "")):
        x = got[k].text.replace(" ", "")[:24]
        assert got[k].text.endswith(tail) and x != iban and int(x[4:] + "1428" + x[2:4]) % 97 == 1
    assert got[6].text.endswith(" PAID") and valid not in got[6].text and got[9].text.endswith(" 9999 9999") and got[9].text != texts[9]
    month, day, year = map(int, got[7].text.split("/"))
    assert 1 <= month <= 12 < day <= 31 and got[7].text != texts[7]
    late = spark.range(0, 292194, 11).select(F.expr("date_add(date'1600-01-01', cast(id as int))").alias("d")).where("day(d) > 12")
    late = late.select(F.expr("date_format(d, 'MM/dd/yyyy')").alias("m")).select(F.expr(pii._late_date("m", "k")).alias("o"))
    assert late.distinct().count() == late.count() and late.where("cast(substr(o, 4, 2) as int) <= 12").isEmpty()


def test_pii_permutes(spark):
    """All values of a small format map to each other."""
    df = spark.range(1000).select(F.format_string("%03d", "id").alias("v"))
    out = [r.o for r in df.select(F.expr(pii.permuted("v", "k")).alias("o")).collect()]
    assert sorted(out) == [f"{i:03d}" for i in range(1000)] and sum(o == f"{i:03d}" for i, o in enumerate(out)) < 20
    days = spark.range(0, 292194, 7).select(F.expr("date_format(date_add(date'1600-01-01', cast(id as int)), 'yyyy-MM-dd')").alias("m"))
    got = days.select(F.expr(pii._date("m", "yyyy-MM-dd", "k")).alias("o"))
    assert got.distinct().count() == got.count() and got.where(F.try_to_date("o", "yyyy-MM-dd").isNull()).isEmpty()


def test_pii_one_to_one(spark):
    """Different valid values get different valid pseudonyms, of the same kind."""
    rng = np.random.default_rng(13)
    ssn = {f"{a:03d}-{g:02d}-{n:04d}" for a, g, n in zip(rng.integers(1, 900, 20000), rng.integers(1, 100, 20000), rng.integers(1, 10000, 20000)) if a != 666}
    hexes = {"".join("0123456789abcdef"[x] for x in rng.integers(0, 16, 32)) for _ in range(300)}
    hexes |= {x.upper() for x in hexes} | {x[:16] + x[16:].upper() for x in hexes} | {x[:16].upper() + x[16:] for x in hexes}
    mails = {f"{c}@x.org" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}
    values = sorted(ssn) + sorted(hexes) + sorted(mails)
    got = pii.pseudonymise(spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(4), "key").orderBy("doc_id").collect()
    out = [r.text for r in got]
    assert len(set(out)) == len(out) and all(r.n_found for r, v in zip(got, values) if "-" in v)
    assert all(re.fullmatch(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}", o) for o, v in zip(out, values) if v in ssn)
    cases = lambda x: (bool(re.search("[a-f]", x)), bool(re.search("[A-F]", x)))
    assert all(cases(o) == cases(v) and len(o) == 32 for o, v in zip(out, values) if v in hexes)
    assert {o for o, v in zip(out, values) if v in mails} == mails and sum(o != v for o, v in zip(out, values) if v in mails) > 50


def test_pii_long_text(spark):
    """A very long text with very many values."""
    text = " ".join(f"row {i} 4111 1111 1111 1111 and 10.0.{i % 256}.{i // 256}" for i in range(4000))
    got = pii.pseudonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), "key").first()
    assert got.n_found == 8000 and "4111 1111 1111 1111" not in got.text and len(got.text.split()) == len(text.split())


# -- 10 tokens


def test_tokens(spark, sf):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_trie.MODEL)
    extra = ["  a   b  ", "Hello  world\nfoo \tbar", " " * 37, "日本語 テキスト 🙂 <s>", "a" * 300, "", LONG[:5000], "\n\n x", "ünïcödé ﬁ"]
    rows = [(i, t) for i, t in enumerate(extra)] + [(None, None), (3, extra[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(200))
    texts = docs.collect()
    got = sentencepiece_trie.encode(docs).collect()
    for r, t in zip(got, texts):
        assert (r.token_ids, r.round_trip) == ((None, None) if t.text is None else (lib.encode(t.text), True))
        assert r.n_tokens == len(r.token_ids or [])
    back = sentencepiece_trie.decode(spark.createDataFrame(got)).collect()
    assert [r.text for r in back] == [t.text for t in texts]
    assert sentencepiece_trie.encode(docs.limit(0)).count() == 0


def test_viterbi(tmp_path):
    """A unigram model over a tiny vocabulary against all segmentations."""
    m = object.__new__(sentencepiece_trie.Model)
    vocab = {"a": -3.0, "b": -3.1, "c": -3.3, "ab": -4.0, "bc": -3.9, "abc": -7.0, "ca": -4.2, "▁": -2.0, "▁a": -3.5}
    m.pieces, m.scores, m.kind, m.valid, m.unk_score = list(vocab), list(vocab.values()), sentencepiece_trie.UNIGRAM, {}, -100.0
    m.ids = {p: i for i, p in enumerate(vocab)}

    def best(w):
        if not w:
            return 0.0
        return max((vocab[w[:k]] + best(w[k:]) for k in range(1, 4) if w[:k] in vocab), default=-1e9)

    words = sorted("▁" + "".join(x) for n in range(1, 5) for x in itertools.product("abc", repeat=n))
    for w, ids in zip(words, m.encode_sorted(words)):
        assert "".join(m.pieces[i] for i in ids) == w and sum(m.scores[i] for i in ids) == pytest.approx(best(w))


def unigram_file(path, fallback):
    """The public vocabulary as the file of a unigram model whose scores are the negative ranks, with or without byte fallback."""
    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    out = b""
    for field, value in sentencepiece_trie._fields(sentencepiece_trie.read(sentencepiece_trie.MODEL)):
        if field == 1:
            piece = dict(sentencepiece_trie._fields(value))
            if not fallback and piece.get(3) == sentencepiece_trie.BYTE:
                continue
            if 2 in piece:  # the score, but no -1e9, beside which single precision tells no ranks apart
                value += b"\x15" + np.maximum(np.frombuffer(piece[2], "<f4"), np.float32(-40_000)).tobytes()
        if field == 2:  # the last value of a field counts: model_type, byte_fallback
            value += b"\x18\x01" + b"\x98\x02" + bytes([fallback])
        out += bytes([field << 3 | 2]) + varint(len(value)) + value
    path.write_bytes(out)
    return str(path)


@pytest.mark.parametrize("fallback", [0, 1])
def test_unigram(spark, sf, tmp_path, fallback):
    """Viterbi over a whole vocabulary, characters without a piece included, against the public library. Texts are short: the library adds
    up scores in single precision, which is exact for these whole numbers below 2^24 only."""
    import sentencepiece

    path = unigram_file(tmp_path / "unigram.model", fallback)
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    extra = ["a  b", "日本語 テキスト 🙂🙂 x🙂y <s>", " " * 40, "a" * 300, "", "ünïcödé ﬁ 龘龘龘龘", "\n\n x"]
    some = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    rows = list(enumerate(extra + [t[k : k + 300] for t in some for k in range(0, min(len(t), 3000), 300)]))
    got = sentencepiece_trie.encode(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    for r, (_, t) in zip(got, rows):
        assert r.token_ids == lib.encode(t or "")


def test_long_runs_of_blanks():
    """Runs that no word ends are merged in n log n, to what the public library gives."""
    import time

    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_trie.MODEL)
    m = sentencepiece_trie.Model(sentencepiece_trie.read(sentencepiece_trie.MODEL))
    for n in (1, 2, 17, 33, 250):
        text = f"x{' ' * n}y"
        words = sentencepiece_trie.WORD.findall(m.marked(text))
        assert [i for w in words for i in m.encode_words({w})[w]] == lib.encode(text)
    began = time.time()
    m.merge(sentencepiece_trie.MARK * 200_000)
    assert time.time() - began < 20


def test_tokens_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x", None)], "doc_id long, text string, n_tokens int, token_ids string, round_trip string")
    got = sentencepiece_trie.encode(df)
    assert got.columns == ["doc_id", "n_tokens", "token_ids", "round_trip"] and got.first().round_trip
    assert sentencepiece_trie.decode(got.withColumn("text", F.lit("old"))).first().text == "a b"


# -- pipeline


def test_pipeline_odd(spark, tmp_path):
    """Nulls, empty texts, repeated rows, groups without ids, clashing columns and empty tables through every stage."""
    import corpus_pipeline as p

    words = [f"w{k}" for k in range(60)]
    near = lambda k: " ".join(words[:40] + [f"e{k}"] + words[41:])
    texts = [(1, near(1)), (2, near(2)), (2, near(2)), (2, "some other clean text of the same id that links with nothing at all " + "z y x " * 3), (None, near(3)), (None, "null one " + near(99) + " q" * 30), (None, "null one " + near(99) + " q" * 30 + " r"), (None, None), (5, ""), (6, " \n"), (7, "line\nline\nshort text")]
    cols = "doc_id long, text string, lang string, source string, n_chars long, th long, `group` long, node long, key string, copy int, k int, gone long"
    docs = spark.createDataFrame([(i, t, None, None if k % 3 else "s", None, 1, 2, 3, "k", 4, 5, 6) for k, (i, t) in enumerate(texts)], cols)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in p.STAGES:
        got = stage(spark, docs, str(tmp_path))
        rows = got.collect()
        if name != "sentencepiece":
            assert got.columns == p.COLUMNS
        if name == "ngram_jaccard_join":
            kept = sorted(((r.doc_id, r.text) for r in rows), key=str)
            assert kept == sorted([(1, near(1)), texts[3], min(texts[5:7], key=lambda x: x[1]), texts[7], texts[8], texts[9], texts[10]], key=str) or len(kept) == 7
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert p.run(spark, "/root/testdata/sf0.001").count() > 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as p

    base = "/root/testdata/sf0.001"
    for t in ("documents", "labels"):
        spark.read.parquet(f"{base}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in p.STAGES:
        path = str(tmp_path / f"out-{name}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs
    assert [n for n, _ in p.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "mix_sources", "sentencepiece"]
    for name in list(kept)[:-1]:
        assert set(kept[name].columns) == set(p.COLUMNS)
    labels = spark.read.parquet(str(tmp_path / "labels.parquet"))
    good = labels.where("quality = 1").join(kept["quality_classifier"], "doc_id", "left_semi").count()
    assert good >= 0.97 * labels.where("quality = 1").count()
    rows = [(r.doc_id, r.text) for r in kept["line_dedup"].collect()]
    want = {i for i, (_, c) in brute_components(rows, 5, 80).items() if c == i}
    assert {r.doc_id for r in kept["ngram_jaccard_join"].collect()} == want
    assert kept["sentencepiece"].where("round_trip").count() == kept["mix_sources"].count()
    assert os.listdir(tmp_path)
