"""Duplicates, fingerprints, scans and the pipeline: SQL where it exists, brute force elsewhere."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare, duck

import corpus_pipeline
from panelloom.llm import common, components, decontam, licenses, lines, merkle, omh, pii, queries

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD = [
    (1, None), (2, ""), (3, "   \n\n"), (4, "same words here for all of us to read again"), (4, "same words here for all of us to read again"),
    (5, "Same words here for all of us to read again!"), (None, "a null identifier with several words in it"), (7, "x" * 50_000),
    (8, "short"), (9, "short"), (10, "."), (11, "."),
]


def odd(spark):
    """Rows with nulls, empty and long texts, repeats, and columns named like results."""
    return spark.createDataFrame(
        [(i, t, "x", "y") for i, t in ODD], "doc_id long, text string, n_words string, __bucket string")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), name, queries.QUERIES, queries.ORACLE, SF) == []


# ---- lines ------------------------------------------------------------------------------------


def test_lines_of_odd_rows(spark):
    line = "A line of more than twenty characters"
    rows = [(1, f"{line}\nown one"), (2, f"  {line.upper()}\t\nown two\n{line}"), (3, f"x\n{line}"), (3, f"x\n{line}"),
            (4, None), (5, ""), (None, line)]
    frame = spark.createDataFrame([(*r, "kept", 9) for r in rows], "doc_id long, text string, source string, n_dropped int")
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped, r.source) for r in lines.dedup_lines(frame).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "own one", 2, 1, "kept"), (2, "own two", 3, 2, "kept"), (3, f"x\n{line}", 2, 0, "kept"),
        (3, f"x\n{line}", 2, 0, "kept"), (4, None, 1, 0, "kept"), (5, "", 1, 0, "kept"), (None, "", 1, 1, "kept")], key=str)
    assert lines.dedup_lines(frame.limit(0)).count() == 0


# ---- near duplicates --------------------------------------------------------------------------


def classes_by_all_pairs(texts):
    marks = {i: omh.shingles(omh.FIND(t.lower())) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, m in marks.items():
        for x in m.tolist():
            holders[x].append(i)
    shared = Counter()
    for ids in holders.values():
        for at, a in enumerate(ids):
            for b in ids[:at]:
                shared[b, a] += 1
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if n >= 0.8 * max(len(marks[a]), len(marks[b])) and omh.aligned(marks[a], marks[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in texts}


def test_classes_equal_all_pairs(spark, documents):
    got = {r.doc_id: r.class_id for r in queries.op3_order_minhash(spark, SF).collect()}
    assert got == classes_by_all_pairs(documents)


def slow_alignment(a, b):
    before = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(before[j] + 1 if x == y else max(before[j + 1], now[-1]))
        before = now
    return before[-1] / (len(a) + len(b) - before[-1])


def test_banded_alignment_is_exact():
    rng = np.random.default_rng(4)
    near = 0
    for _ in range(200):
        words = [f"w{x}" for x in rng.integers(0, 40, int(rng.integers(6, 90)))]
        other = list(words)
        for _ in range(int(rng.integers(0, 4))):
            at = int(rng.integers(0, len(other)))
            other[at:at + int(rng.integers(0, 2))] = [f"n{rng.integers(9)}"] * int(rng.integers(0, 3))
        if rng.random() < 0.3:
            cut = len(other) // 2
            other = other[cut:] + other[:cut]
        a, b = omh.shingles(words), omh.shingles(other)
        want = slow_alignment(a.tolist(), b.tolist()) if len(a) and len(b) else 0
        got = omh.aligned(a, b)
        assert got == pytest.approx(want if want >= 0.8 else 0)
        near += got > 0
    assert near > 40
    assert len(set(omh.shingles(["a"] * 30).tolist())) == 26


def test_order_matters_to_sketches():
    words = [f"w{x}" for x in range(200)]
    turned = words[100:] + words[:100]
    same = set(omh.sketches(omh.shingles(words)).tolist())
    assert len(same & set(omh.sketches(omh.shingles(words + ["more"])).tolist())) > 12
    assert len(same & set(omh.sketches(omh.shingles(turned)).tolist())) < 12


def test_near_copies_of_odd_rows_and_a_large_group(spark):
    got = omh.near_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.class_id, r.class_rows))
    assert by[4] == by[5] == {(4, 3)} and by[8] == by[9] == {(8, 2)} and by[10] == by[11] == {(10, 2)}
    assert by[1] == {(1, 1)} and by[None] == {(None, 1)}
    assert omh.near_duplicates(odd(spark).limit(0)).count() == 0
    rng = np.random.default_rng(6)
    base = [f"v{x}" for x in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(400):
        text = list(base)
        text[int(rng.integers(120))] = f"e{i}"
        rows.append((i, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.class_id, r.class_rows) for r in omh.near_duplicates(frame).collect()} == {(0, 400)}


def templated_family(texts, planted, words=200, changed=4, near=4, seed=11):
    """Texts of one template with ``changed`` random words, most pairs at 0.69, and copies at 0.81.

    Returns the texts and the planted pairs (index, index of the copy).
    """
    rng = np.random.default_rng(seed)
    base = [f"t{x}" for x in range(words)]
    out = []
    for i in range(texts):
        own = list(base)
        for at in rng.choice(words, changed, replace=False):
            own[at] = f"u{i}x{at}"
        out.append(own)
    pairs = []
    for i in rng.choice(texts, planted, replace=False).tolist():
        own = list(out[i])
        for at in rng.choice(words, near, replace=False):
            own[at] = f"p{i}x{at}"
        pairs.append((i, len(out)))
        out.append(own)
    return [" ".join(x) for x in out], pairs


def test_close_pairs_in_a_templated_family_are_all_found(spark):
    texts, planted = templated_family(600, 300)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(frame).collect()}
    want = classes_by_all_pairs(dict(enumerate(texts)))
    assert len(set(want.values())) < len(want) - 250 and all(want[a] == want[b] for a, b in planted)
    assert got == want


def test_rows_of_a_templated_family_grow_with_its_size(spark, monkeypatch):
    """Twice the texts give about twice the rows of every staged table, and the classes of all pairs."""
    sizes, plain = {}, omh.staged
    for count in (1000, 2000):
        rows = sizes[count] = []
        monkeypatch.setattr(omh, "staged", lambda df: (out := plain(df), rows.append(out.count()))[0])
        texts, planted = templated_family(count, 100)
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: r.class_id for r in omh.near_duplicates(frame).collect()}
        assert all(got[a] == got[b] for a, b in planted)
        if count == 1000:
            assert got == classes_by_all_pairs(dict(enumerate(texts)))
    assert len(sizes[1000]) == len(sizes[2000])
    assert sum(sizes[2000]) < 2.6 * sum(sizes[1000]) and max(sizes[2000]) < 2.6 * max(sizes[1000])


def test_pieces_in_chunks_give_the_same_pairs(spark):
    texts, planted = templated_family(150, 60)
    frame = spark.createDataFrame([(f"{i:03d}".encode(), t) for i, t in enumerate(texts)], "key binary, text string")
    marked = common.staged(common.map_batches(frame, omh._shingled, "key binary, marks array<bigint>, bits array<bigint>")
                           .selectExpr("monotonically_increasing_id() as row", "xxhash64(key) % 7 as gid", "marks", "bits"))
    whole = {tuple(r) for r in omh._prefix_pairs(marked).collect()}
    assert len(whole) >= 30 and whole == {tuple(r) for r in omh._prefix_pairs(marked, chunk=16).collect()}


def test_pairs_that_bits_leave_open_are_never_written(spark, monkeypatch):
    """Texts just under the bound: rows that leave a task grow with the texts, and all links are found."""
    made, plain = {}, omh.map_batches
    for count in (150, 300):
        own = made[count] = []
        texts, planted = templated_family(count, 20, changed=2, near=6)
        frame = spark.createDataFrame([(f"{i:03d}".encode(), t) for i, t in enumerate(texts)], "key binary, text string")
        marked = common.staged(plain(frame, omh._shingled, "key binary, marks array<bigint>, bits array<bigint>")
                               .selectExpr("monotonically_increasing_id() as row", "xxhash64(key) as gid", "key", "marks", "bits"))
        with monkeypatch.context() as m:
            m.setattr(omh, "map_batches", lambda df, fn, schema: (out := common.staged(plain(df, fn, schema)), own.append(out.count()))[0])
            links = omh._prefix_pairs(marked.drop("key"), forest=True)
            got = {r.node: r.component for r in components.components(links).collect()}
        rows = {r.row: omh.shingles(omh.FIND(texts[int(bytes(r.key))])) for r in marked.select("row", "key").collect()}
        near = [(a, b) for a in rows for b in rows if a < b and omh.aligned(rows[a], rows[b])]
        assert len(near) > count and all(got[a] == got[b] for a, b in near)
        assert links.count() < 30 * len(rows)
    assert max(made[300]) < 2.6 * max(made[150])


def test_shares_of_long_pieces_give_the_same_pairs(spark):
    texts, planted = templated_family(80, 40)
    frame = spark.createDataFrame([(f"{i:03d}".encode(), t) for i, t in enumerate(texts)], "key binary, text string")
    marked = common.staged(common.map_batches(frame, omh._shingled, "key binary, marks array<bigint>, bits array<bigint>")
                           .selectExpr("monotonically_increasing_id() as row", "xxhash64(key) % 7 as gid", "marks", "bits"))
    whole = {tuple(r) for r in omh._prefix_pairs(marked).collect()}
    assert len(whole) >= 20
    for chunk in (omh.CHUNK, 16):
        assert whole == {tuple(r) for r in omh._prefix_pairs(marked, chunk=chunk, limit=1500).collect()}


def test_parity_bits_bound_the_difference():
    a, b = omh.shingles([f"w{x}" for x in range(300)]), omh.shingles([f"w{x}" for x in range(20, 310)])
    differing = sum(int(x).bit_count() for x in (omh.parity(a) ^ omh.parity(b)).view(np.uint64))
    assert 0 < differing <= len(set(a.tolist()) ^ set(b.tolist()))


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    frame = spark.createDataFrame(edges + edges[:5], "a long, b long")
    got = {r.node: r.component for r in components.components(frame).collect()}
    want = {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200, 202: 200}
    assert got == want
    assert components.components(frame.limit(0)).count() == 0


# ---- fingerprints -----------------------------------------------------------------------------


def test_fingerprints_by_brute_force(spark, documents):
    order = sorted(documents, reverse=True)
    rows = {r.doc_id: r for r in queries.op6_merkle(spark, SF).collect()}
    assert len(rows) == len(order)
    closer = []
    for at, i in enumerate(order):
        own, following = documents[i] or "", documents[order[(at + 1) % len(order)]] or ""
        half = len(own) // 2
        changed = own[:len(own) - half] + following[:half]
        row = rows[i]
        assert row.n_chars == len(own)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.fingerprint == merkle.fingerprint(own) and row.edited_fingerprint == merkle.fingerprint(changed)
        assert row.near_edited == merkle.likeness(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == merkle.likeness(row.fingerprint, merkle.fingerprint(following))
        closer.append(row.near_edited >= row.near_next)
    assert np.mean(closer) > 0.9


def test_fingerprints_of_odd_rows(spark):
    rows = merkle.compare_with_next(odd(spark)).collect()
    assert len(rows) == len(ODD)
    assert len({r.fingerprint for r in rows if r.doc_id in (10, 11)}) == 1
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert merkle.compare_with_next(odd(spark).limit(0)).count() == 0
    one = merkle.compare_with_next(odd(spark).filter("doc_id = 8")).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(5, 1.0)]


def test_texts_without_marks_are_compared_in_pieces():
    rng = np.random.default_rng(17)
    words = [f"w{x}" for x in rng.integers(0, 10_000, 400)]
    one, other = " ".join(words), " ".join(words) + "x"
    assert 0.9 < merkle.likeness(merkle.fingerprint(one), merkle.fingerprint(other)) < 1
    run = "".join(rng.choice(list("abcdefghijklmnop"), 5000))  # not even a space
    assert 0.9 < merkle.likeness(merkle.fingerprint(run), merkle.fingerprint(run[:2500] + "!" + run[2500:])) < 1
    for line in (one, run, "a. b", "a b", " a  b ", "", "x" * 300, "a. " + run + " b"):
        pieces = merkle.leaves(line)
        assert "".join(p + (" " if spaced else "") for p, spaced in pieces)[:-1] == line
    assert len({merkle.fingerprint(t) for t in ("a. b", "a.b", "a b", "ab", "a.  b", "a.\nb", "a. b ")}) == 7


def test_differing_branches_locate_the_edit():
    paragraphs = [f"paragraph {i}. with two sentences" for i in range(200)]
    a = merkle.fingerprint("\n".join(paragraphs))
    changed = [*paragraphs[:50], "another one", *paragraphs[51:]]
    assert merkle.differing(a, merkle.fingerprint("\n".join(changed))) == ((50, 51), (50, 51))
    assert merkle.differing(a, a) is None
    longer = [*paragraphs[:120], "new", "newer", *paragraphs[120:]]
    assert merkle.differing(a, merkle.fingerprint("\n".join(longer))) == ((120, 120), (120, 122))


# ---- personal data ----------------------------------------------------------------------------

PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub(r"[^0-9]", "", m)) <= 19 and sum(
        sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"[^0-9]", "", m)) <= 15),
)


def plain_spans(text):
    found = [(m.start(), k, m.end(), name) for k, (name, pattern, right) in enumerate(PLAIN)
             for m in re.finditer(pattern, text) if right(m.group())]
    return [f"{name}:{s}:{e}" for s, _, e, name in sorted(found)]


def test_base_spans_equal_the_expressions(spark, documents):
    texts = [t or "" for t in documents.values()]
    texts += ["a@b.c@d.e @x.y p+q@r-s.t-u.v", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3", "4111 1111-1111 1111 5",
              "+1+2 (3) 4567890123 +49 (0) 89 1234567 +1", "a@b a@b. x@y.z.", "0000 0000 0000 00", "é 1.1.1.1@a.b +123456789012345678"]
    rng = np.random.default_rng(8)
    texts += ["".join(rng.choice(list("a1.@+- (5"), 60)) for _ in range(500)]
    for text in texts:
        assert [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.base_spans(text)] == plain_spans(text), text[:200]


def test_personal_data_query(spark, documents):
    for row in queries.op8_pii(spark, SF).collect():
        want = plain_spans(documents[row.doc_id] or "")
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            sum(w.startswith(name + ":") for w in want) for name in pii.KINDS)
        assert set(want) <= set(row.spans.split(",")) | ({""} if not want else set())


def test_bootstrapping_finds_what_the_expressions_miss(spark):
    rows = [(i, f"please call me at +1 (555) 555-{1000 + i} any day") for i in range(12)]
    rows += [(50, "please call me at 555-555-1234 any day"), (51, "order number is 555-555-9876 in stock"), (52, None), (53, ""),
             (50, "please call me at 555-555-1234 any day")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    got = [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in pii.find(frame).collect()]
    assert len(got) == len(rows)
    added = {i: s for i, b, s in got if s != b}
    assert added == {50: [(3, 18, 30)]}
    assert sum(1 for i, b, s in got if i == 50 and s) == 2
    assert pii.find(frame.limit(0)).count() == 0


def accepted_by_hand(edges):
    """(kind, instance) by the stated scores, over sets."""
    marked = defaultdict(set)
    seeds = {(k, i) for k, i, seed, _ in edges if seed}
    for k, i, _, p in edges:
        marked[k, p].add(i)
    score, good = {}, {}
    while True:
        now = {}
        for (k, p), instances in marked.items():
            top = low = 0.0
            for i in instances:
                if (k, i) in seeds:
                    top, low = top + 1, low + 1
                elif any((o, i) in seeds for o in range(4)):
                    low += 1
                elif (k, i) in score:
                    top, low = top + score[k, i], low + 1
                else:
                    low += pii.UNKNOWN
            if sum((k, i) in seeds for i in instances) >= pii.SUPPORT and top / (low + pii.SMOOTHING) >= pii.CONFIDENCE:
                now[k, p] = top / (low + pii.SMOOTHING)
        if len(now) <= len(good):
            return {x for x, v in score.items() if v >= pii.INSTANCE_SCORE}
        good, doubt = now, defaultdict(lambda: 1.0)
        for (k, p), c in good.items():
            for i in marked[k, p]:
                if not any((o, i) in seeds for o in range(4)):
                    doubt[k, i] *= 1 - c
        score = {x: 1 - v for x, v in doubt.items()}


def test_graph_scores_by_brute_force(spark):
    rng = np.random.default_rng(21)
    edges = []
    for p in range(40):
        purity = rng.random()
        for _ in range(int(rng.integers(4, 40))):
            k, own = int(rng.integers(0, 2)), rng.random() < 0.5 + purity / 2
            edges.append((k, f"{'s' if own else 'u'}{int(rng.integers(0, 60))}{'' if own else k}", bool(own), f"p{p}"))
    edges += [(0, f"s{i}", True, "clear") for i in range(30)] + [(0, "fresh", False, "clear"), (0, "fresh", False, "p0")]
    frame = spark.createDataFrame(edges, "kind int, instance string, seed boolean, pattern string")
    want = accepted_by_hand(edges)
    assert {(r.kind, r.instance) for r in pii.score_graph(frame).collect()} == want and (0, "fresh") in want


def test_unlabelled_contexts_add_nothing_and_true_ones_add_all(spark):
    rows = [f"the parcel number is +1 (555) 555-{1000 + i} today" for i in range(5)]
    rows += [f"the parcel number is 555-777-{1000 + i} today" for i in range(100)]  # five seeds among 105
    rows += [f"please ring me under +49 89 {100000 + i} soon" for i in range(100)]
    rows += [f"please ring me under 089/{200000 + i}x7 soon" for i in range(30)]  # no expression knows this shape
    rows += ["please ring me under 5 soon", "please ring me under pressure soon"]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    added = {r.doc_id: [tuple(x) for x in r.spans if x not in r.base] for r in pii.find(frame).collect()}
    assert all(not added[i] for i in range(205)) and not added[235] and not added[236]
    for i in range(205, 235):
        start = rows[i].index("089/")
        assert added[i] == [(3, start, start + len("089/200000x7"))]


def test_contexts_look_as_far_as_words_reach():
    long = "w" * 500
    text = f"a {long} {'v' * 300} 5551234567 {long} b"
    at = text.index("555")
    assert pii.contexts(text, at, at + 10) == [f"<< {long} {'v' * 300}", f"<> {'v' * 300} _ {long}"]
    assert pii.contexts("5551234567", 0, 10) == [] and pii.contexts("x 5551234567", 2, 12) == []


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1.2.3." * 100_000, "+1 " * 100_000, "(555) " * 50_000, "@" * 100_000):
        pii.loose_spans(text, pii.base_spans(text))


# ---- licenses ---------------------------------------------------------------------------------


def license_hits(text):
    words = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    marks = [" ".join(words[i:i + 5]) for i in range(len(words) - 4)]
    found = set()
    for name, template in licenses.TEMPLATES:
        t = [w for w in re.split(r"[^\w]|_", template.lower()) if w]
        want = {" ".join(t[i:i + 5]) for i in range(len(t) - 4)}
        for at in range(len(marks)):
            if len(want & set(marks[at:at + len(t) - 4])) >= 0.8 * len(want):
                found.add(name)
    return found


def test_license_scan_by_brute_force(spark, documents):
    got = defaultdict(set)
    for r in queries.op9_license_scan(spark, SF).collect():
        got[r.doc_id].add(r.license)
    assert got == {i: hits for i, t in documents.items() if (hits := license_hits(t))}


def test_edited_notices_are_found(spark):
    rng = np.random.default_rng(9)
    other = " ".join(f"word{x}" for x in rng.integers(0, 1000, 300))
    rows, want = [], set()
    for i, (name, template) in enumerate(licenses.TEMPLATES):
        words = template.split()
        rows.append((2 * i, f"{other} {template} {other}"))
        want.add((2 * i, name))
        if len(words) > 26:  # one changed word costs at most five shingles
            words[len(words) // 2] = "changed"
            rows.append((2 * i + 1, f"{other} {' '.join(words)} {other}"))
            want.add((2 * i + 1, name))
    rows += [(900, None), (901, ""), (902, "the license"), (903, other)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    got = {(r.doc_id, r.license) for r in licenses.scan(frame).collect()}
    assert want <= got and {i for i, _ in got} == {i for i, _ in want}
    assert licenses.scan(frame.limit(0)).count() == 0


def test_words_put_into_a_notice_do_not_hide_its_tail(spark):
    free = ("This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License, version 2 or later, as published by the Free Software Foundation")
    long = [f"term{x}" for x in range(104)]
    put = [*long[:50], *[f"put{x}" for x in range(20)], *long[50:]]
    far = [*long[:50], *[f"put{x}" for x in range(500)], *long[50:]]
    rows = [(1, free), (2, " ".join(put)), (3, " ".join(far)), (5, " ".join(long[:70])), (1, free)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    templates = (*licenses.TEMPLATES, ("Long", " ".join(long)))
    got = sorted({(r.doc_id, r.license, r.start, r.containment) for r in licenses.scan(frame, templates=templates).collect()})
    assert got == [(1, "GPL", 0, 0.84), (2, "Long", 0, 0.96), (3, "Long", 0, 0.96)]


# ---- decontamination --------------------------------------------------------------------------


def test_hits_of_odd_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    bench = spark.createDataFrame(
        [(1, item), (1, item), (2, "lonely"), (3, None), (4, "!!"), (10, "lonely"), (None, "one")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"x {item.upper()} y", "a"), (2, "one two three four", "b"), (3, None, "c"), (4, "", "d"), (5, "a LONELY, word", "e"),
         (5, "a LONELY, word", "e"), (6, f"{item} {item}", "f"), (None, "lonely lonely", "g")], "doc_id long, text string, n_hit string")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated)
                  for r in decontam.phrase_hits(docs, bench).collect()), key=str)
    assert got == sorted([
        (1, 16, 14, "1", True), (2, 4, 0, "", False), (3, 0, 0, "", False), (4, 0, 0, "", False), (5, 3, 1, "10,2", True),
        (5, 3, 1, "10,2", True), (6, 28, 28, "1", True), (0, 2, 2, "10,2", True)], key=str)
    assert decontam.phrase_hits(docs.limit(0), bench).count() == 0
    assert decontam.phrase_hits(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    index = decontam.Index(docs, bench)
    near = {r.id for r in decontam.near_items(index).collect()}
    assert near == {"1", "2", "10"}


def near_by_hand(docs, items, within=13):
    def words(t):
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if w]

    lists = {i: words(t) for i, t in docs}
    f = Counter(w for ws in lists.values() for w in ws)
    out = set()
    for item, text in items:
        w = words(text)
        n = min(len(w), within)
        for s in range(len(w) - n + 1 if w else 0):
            ranked = sorted(range(s, s + n), key=lambda p: (f[w[p]], p))[:2]
            if f[w[ranked[0]]] == 0:
                continue
            for i, ws in lists.items():
                places = [[a for a, x in enumerate(ws) if x == w[p]] for p in ranked]
                if (places[0] if len(ranked) == 1 else any(a != b and abs(a - b) < within for a in places[0] for b in places[1])):
                    out.add((i, str(item)))
    return out


def test_proximity_of_long_items_by_brute_force(spark):
    rng = np.random.default_rng(14)
    names = [f"w{x}" for x in range(300)]
    items = [(k, " ".join(rng.choice(names, n))) for k, n in enumerate((40, 25, 13, 5, 1, 60, 16))] + [(9, "twin a twin")]
    docs = [(i, " ".join(rng.choice(names, int(rng.integers(5, 200))))) for i in range(60)]
    docs += [(100, f"x {items[0][1]} y"), (101, " ".join(reversed(items[5][1].split()))), (102, "twin b twin a"), (103, "twin a")]
    # the rarest words of the whole item stand far apart; a verbatim copy must be found all the same
    far = "rare0 " + " ".join(["w1", "w2", "w3", "w4"] * 9) + " rare1"
    items, docs = [*items, (20, far)], [*docs, (104, f"w9 {far} w8")]
    index = decontam.Index(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.i, r.id) for r in decontam.near_items(index).collect()}
    assert got == near_by_hand(docs, items) and {(104, "20"), (100, "0"), (101, "5"), (102, "9")} <= got


# ---- the pipeline -----------------------------------------------------------------------------


def test_pipeline_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = corpus_pipeline.language(spark, docs, SMALL)
    assert tuple(first.columns) == corpus_pipeline.COLUMNS
    left = {r.doc_id: r.text for r in first.collect()}
    assert left.items() <= texts.items() and len(left) > 0.95 * len(texts)
    keys = {i: [x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                for x in t.split("\n")] for i, t in left.items()}
    holders = defaultdict(set)
    for i, ks in keys.items():
        for k in ks:
            holders[k].add(i)
    deduped = {}
    for i, t in left.items():
        kept = [x for x, k in zip(t.split("\n"), keys[i]) if len(k) < 20 or len(holders[k]) < 3 or i == max(holders[k])]
        if kept:
            deduped[i] = "\n".join(kept)
    of = classes_by_all_pairs(deduped)
    same = defaultdict(list)
    for i, t in deduped.items():
        same[" ".join(omh.FIND(t.lower())) or "\0" + t].append(of[i])
    alone = {i for i, c in of.items() if i == c}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]

    def words(t):
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(
            str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]

    grams = {tuple(w[s:s + 13]) for w in map(words, items) for s in range(max(1, len(w) - 12)) if w}
    clean = set()
    for i in alone:
        w, hit = words(deduped[i]), set()
        for s in range(len(w)):
            for n in (13, *{len(g) for g in grams if len(g) < 13}):
                if tuple(w[s:s + n]) in grams:
                    hit |= set(range(s, s + n))
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(clean)
    assert all(r.n_tokens == len(r.ids) > 0 for r in out)


def test_stages_on_odd_rows(spark):
    docs = odd(spark).selectExpr("doc_id", "text", "cast(null as string) as lang", "'s' as source", "0L as n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 4, 7, 8]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd(spark).selectExpr(
            "doc_id", "text", "cast(null as string) as lang", "'s' as source", "0L as n_chars").limit(0), SMALL).count() == 0
