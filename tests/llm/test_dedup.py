"""Exact, line and near-duplicate removal against direct definitions."""

import re
from collections import defaultdict

import numpy as np
import pytest

from longrec.llm import components, exact_dedup, line_dedup, ngram_join, passages
from longrec.session import cut_lineage

SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    """Ids and texts with extra columns that clash with the operators' own names."""
    data = [(i, t, f"x{k}", k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, id string, `Bytes` int")


EDGE = [(1, "a"), (2, "a"), (2, "a"), (None, "a"), (3, None), (4, ""), (None, "lone"), (5, "bb"), (6, "bc"), (6, "bb"), (7, "w" * 300_000)]


def test_exact_classes(spark):
    got = exact_dedup.classify(frame(spark, EDGE)).collect()
    groups = defaultdict(list)
    for i, text in EDGE:
        groups[text or ""].append(i)
    assert len(got) == len(EDGE)
    by_sha = defaultdict(list)
    for row in got:
        by_sha[row.text_sha256].append(row)
    assert len(by_sha) == len(groups)
    assert sorted(len(g) for g in by_sha.values()) == sorted(len(g) for g in groups.values())
    for rows in by_sha.values():
        assert sum(r.kept for r in rows) == 1
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert {r.keep_id for r in rows} == {max(ids) if ids else None}
        assert all(r.group_size == len(rows) for r in rows)


def test_exact_keep_one(spark):
    docs = frame(spark, EDGE)
    got = exact_dedup.keep_one(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, (r.text or "")[:9]) for r in got.collect()), key=repr)
    assert kept == sorted([(2, "a"), (4, ""), (None, "lone"), (6, "bc"), (6, "bb"), (7, "w" * 9)], key=repr)
    # the same rows as the classes say
    same = exact_dedup.classify(docs).where("kept").count()
    assert len(kept) == same


def test_exact_empty(spark):
    empty = frame(spark, EDGE).limit(0)
    assert exact_dedup.classify(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0


def test_exact_same_prefix_and_length(spark):
    head = "h" * 400
    got = exact_dedup.keep_one(frame(spark, [(1, head + "a"), (2, head + "b"), (3, head + "a")]))
    assert sorted(r.doc_id for r in got.collect()) == [2, 3]


def brute_lines(rows, least):
    seen, result = set(), {}
    for i, text in sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0)):
        lines = [(p, x.strip(" "), len(x.split())) for p, x in enumerate(text.split("\n"))]
        lines = [x for x in lines if x[2]]
        gone = set()
        for side in (1, -1):
            ordered = lines[::side]
            for a in range(len(ordered)):
                size, b = 0, a
                while b < len(ordered) and size < least:
                    size += ordered[b][2]
                    b += 1
                if size < least:
                    continue
                key = (side, tuple(x[1] for x in ordered[a:b]))
                place = (i is not None, i or 0, ordered[a][0] if side > 0 else ordered[b - 1][0])
                seen.add((key, place))
                result.setdefault((i, text), []).append((key, place, [x[0] for x in ordered[a:b]]))
    first = {}
    for key, place in seen:
        first[key] = min(first.get(key, place), place)
    ends = {(key, place): max(own) for found in result.values() for key, place, own in found}
    out = []
    for i, text in rows:
        gone = set()
        for key, place, own in result.get((i, text or ""), []):
            # in the same text the first one must have ended
            if place[:2] != first[key][:2] or min(own) > ends[key, first[key]]:
                gone |= set(own) if place > first[key] else set()
        out.append((i, len(gone), "\n".join(x for p, x in enumerate((text or "").split("\n")) if p not in gone)))
    return sorted(out, key=repr)


PASSAGE = "one two three\nfour five\n\nsix seven eight nine\n ten "
LINES = [
    (1, f"x\n{PASSAGE}\ny"), (2, PASSAGE), (2, PASSAGE), (None, f"{PASSAGE}\nz z z"), (3, None), (4, ""), (5, "a a a\n" * 4),
    (6, "four five\nsix seven eight nine"), (7, "q " * 20), (8, "\n" + "q " * 20), (9, "long line " * 20_000),
]


def test_lines(spark):
    got = line_dedup.dedup_lines(frame(spark, LINES).withColumnRenamed("Bytes", "n_deleted"), min_words=6)
    assert got.columns == ["doc_id", "text", "id", "n_deleted", "n_deleted_"]
    assert sorted(((r.doc_id, r.n_deleted_, r.text) for r in got.collect()), key=repr) == brute_lines(LINES, 6)


def brute_passages(rows, least):
    """Texts without every run of words that stood earlier, by all windows of ``least`` words."""
    documents = sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    first, gone = {}, defaultdict(set)
    for number, (_, text) in enumerate(documents):
        words = text.split()
        for at in range(len(words) - least + 1):
            doc, start = first.setdefault(tuple(words[at : at + least]), (number, at))
            if doc != number or at >= start + least:
                gone[number] |= set(range(at, at + least))
    out = {}
    for number, (i, text) in enumerate(documents):
        pieces, own = re.findall(r"\s*\S+", text), gone[number]
        tail, result, at = text[len("".join(pieces)) :], "", 0
        while at < len(pieces):
            if at not in own:
                result += pieces[at]
                at += 1
                continue
            end = at
            while end in own:
                end += 1
            before = re.match(r"\s*", pieces[at])[0]
            after = re.match(r"\s*", pieces[end])[0] if end < len(pieces) else None
            if after is None:
                result += before if at == 0 else ""
            elif at > 0 and "\n" in after:
                result += pieces[end]
            else:
                result += before + pieces[end].lstrip()
            at = end + (after is not None)
        out[(i, text)] = (len(own), result + tail)
    return sorted(((i, *out[(i, t or "")]) for i, t in rows), key=repr)


RUN = " ".join(f"p{k}" for k in range(55))
INSIDE = [
    (1, f"It says {RUN} here.\nMore"), (2, f"Other words, {RUN.replace(' p20 ', chr(10) + 'p20 ')} end\n\nlast"), (3, f"{RUN}\nafter"),
    (4, f"x\n{RUN}\ny"), (5, f"x {RUN}\n"), (5, f"x {RUN}\n"), (6, f"cut {RUN[8:]}"), (7, RUN[:-25]), (8, "ten words " * 4 + "make a\n" + RUN),
    (9, "a b c d e f g h i j\n" * 12), (10, "a b c d e f g h i j\n" * 6), (None, f"{RUN} {RUN}"), (11, f"It says {RUN} here.\nMore"), (12, None), (13, "  "),
]


@pytest.mark.parametrize("least", [50, 7, 2, 1])
def test_passages(spark, least):
    got = passages.dedup_passages(frame(spark, INSIDE).withColumnRenamed("Bytes", "n_deleted"), min_words=least)
    assert got.columns == ["doc_id", "text", "id", "n_deleted", "n_deleted_"]
    assert sorted(((r.doc_id, r.n_deleted_, r.text) for r in got.collect()), key=repr) == brute_passages(INSIDE, least)
    assert passages.dedup_passages(frame(spark, INSIDE).limit(0)).count() == 0


def test_passages_inside_lines_go(spark):
    rows = frame(spark, INSIDE[:2])
    assert {r.doc_id: r.n_deleted for r in line_dedup.dedup_lines(rows).collect()} == {1: 0, 2: 0}
    assert {r.doc_id: (r.n_deleted, r.text) for r in passages.dedup_passages(rows).collect()}[2] == (55, "Other words, end\n\nlast")


def test_passages_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_deleted, r.text) for r in passages.dedup_passages(docs).collect()), key=repr)
    assert got == brute_passages(rows, 50) and any(n for _, n, _ in got)


def test_lines_that_overlap_themselves(spark):
    line = "a b c d e f g h i j"
    rows = [(1, "\n".join([line] * 10)), (2, "\n".join([line] * 5)), (3, "\n".join([line] * 12))]
    got = {r.doc_id: (r.n_deleted, r.text) for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got == {1: (5, "\n".join([line] * 5)), 2: (5, ""), 3: (12, "")}


def test_lines_empty(spark):
    assert line_dedup.dedup_lines(frame(spark, LINES).limit(0)).count() == 0


def test_lines_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_deleted, r.text) for r in line_dedup.dedup_lines(docs).collect()), key=repr)
    assert got == brute_lines(rows, 50) and any(n for _, n, _ in got)


def brute_near(rows):
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
        sets.append({tuple(words[j : j + 5]) for j in range(max(len(words) - 4, 1))} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, own in enumerate(sets):
        common = defaultdict(int)
        for s in own:
            for other in holders[s]:
                common[other] += 1
            holders[s].append(k)
        for other, n in common.items():
            if 100 * n >= 80 * (len(sets[other]) + len(own) - n):
                parent[find(other)] = find(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


LETTERS = "a b c d e f g h i j k l m n o p q r s t u v w x"
NEAR = [
    (1, "a b c d e f"), (2, "A b c d  e f"), (3, None), (4, ""), (5, "x y"), (None, "x  Y"), (6, " \n"), (7, "x y"), (7, "x y"),
    (8, LETTERS), (9, LETTERS[2:]), (10, "É é"), (11, "é é"), (12, "t u v w x"), (13, "long text " * 30_000), (14, LETTERS + " y z"),
]


def test_near(spark):
    got = ngram_join.similar_components(frame(spark, NEAR))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_near(NEAR)


def test_near_in_a_mended_order(spark, monkeypatch):
    """Common shingles that the sketch takes for rare ones move back; the links are those of any order."""
    common = "this line stands in very many of the texts and links none of them"
    rows = [(k, f"{common} {' '.join(f'w{k // 2}x{j}' for j in range(14 + k % 2))}") for k in range(60)]
    rows += [(100 + k, " ".join(f"w{k}x{j}" for j in range(14))) for k in range(20)] + NEAR
    rows = [(i if i is None else i + 1000 * (n >= 80), t) for n, (i, t) in enumerate(rows)]
    orders, taken = [], ngram_join._prefixes
    monkeypatch.setattr(ngram_join, "_ranks", lambda sketch: np.zeros(1 << ngram_join.SKETCH_BITS, np.uint64))
    monkeypatch.setattr(ngram_join, "_prefixes", lambda rows, ranks, common: orders.append(len(common)) or taken(rows, ranks, common))
    for most, levels in ((100, (64,)), (0, (2, 8, 32)), (1, (4,))):
        monkeypatch.setattr(ngram_join, "MANY_PAIRS", most)
        monkeypatch.setattr(ngram_join, "LEVELS", levels)
        orders.clear()
        got = ngram_join.similar_components(frame(spark, rows))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_near(rows)
        assert len(orders) == 1 if most == 100 else len(orders) > 1


def test_near_empty(spark):
    docs = frame(spark, NEAR).limit(0)
    assert ngram_join.similar_components(docs).count() == 0 and ngram_join.keep_one(docs).count() == 0


def crowd():
    """A crowd of near copies, more than a crowded shingle has, with edits on both sides of the threshold."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        own = list(base)
        for e in range(k % 6):
            own[(k * 7 + e * 23) % 120] = f"edit{k}_{e}"
        rows.append((k, " ".join(own)))
    return rows + [(1000 + k, " ".join(f"v{k}_{j}" for j in range(40))) for k in range(50)]


def test_near_crowd(spark):
    rows = crowd()
    got = ngram_join.similar_components(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_near(rows)


def test_near_keeps_one(spark):
    docs = frame(spark, [(i, t) for i, t in NEAR if i is not None])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = {i for i, _, c in brute_near([(i, t) for i, t in NEAR if i is not None]) if i == c}
    assert {r.doc_id for r in kept.collect()} == wanted


@pytest.mark.parametrize("links", [[], [(1, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)] + [(50, 51), (51, 50)]])
def test_components(spark, links):
    spread = lambda x: hash((x, "node")) % 1_000_003
    got = components.components(cut_lineage(spark.createDataFrame([(spread(a), spread(b)) for a, b in links], "x long, y long")))
    roots = {r.node: r.root for r in got.collect()}
    groups = defaultdict(set)
    for node, root in roots.items():
        groups[root].add(node)
    wanted = []
    for a, b in ((spread(a), spread(b)) for a, b in links if a != b):
        met = [g for g in wanted if a in g or b in g]
        wanted = [g for g in wanted if g not in met] + [set().union({a, b}, *met)]
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted))


def test_near_words_alike_to_polynomials(spark):
    """Words that collide under polynomials modulo powers of two link nothing."""
    def word(n, a, b):
        return "".join(a if bin(k).count("1") % 2 == 0 else b for k in range(n))

    rows = [(k, " ".join(word(n, *signs) for n in (2048, 1024))) for k, signs in enumerate(("ab", "ba"))]
    got = ngram_join.similar_components(frame(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(0, 0), (1, 1)}
