import hashlib
import random
import zlib

from rainfold.llm import merkle as M
from tests.llm.data import awkward_rows, documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, chars):
    return h(*map(field, (doc_id, source, lang, chars, text)))


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    for level in levels[:-1]:
        run = at // 8 * 8
        yield "".join(level[run:at]), "".join(level[at + 1:run + 8])
        at //= 8


def plain(rows):
    """{(doc_id, leaf): (subroot, root, proof, folded, verified)} by the definition."""
    langs = {}
    for i, text, lang, source in rows:
        chars = None if text is None else len(text)
        hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        langs.setdefault(lang, []).append((i, leaf(i, text, lang, source, chars), leaf(i, lower(text), lang, source, chars) if hit else None))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = tree([r[1] for r in langs[lang]])
    top = tree([trees[lang][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        for at, (i, own, changed) in enumerate(langs[lang]):
            steps = [*path(trees[lang], at), *path(top, place)]
            folded = changed or own
            for left, right in steps:
                folded = h(left, folded, right)
            root = top[-1][0]
            out.append((i, own, trees[lang][-1][0], root, h(*[a + b for a, b in steps]), folded, folded == root))
    return sorted(out, key=repr)


def many(n=1400, seed=3):
    rng = random.Random(seed)
    return [(i, f"Row {i} of Many" if rng.random() < 0.6 else f"row {i}", "en" if rng.random() < 0.8 else "de", "s") for i in range(n)]


def found(spark, rows):
    return sorted((tuple(r) for r in M.manifest(documents(spark, rows)).collect()), key=repr)


def test_awkward_rows_by_the_definition(spark):
    rows = awkward_rows()
    assert found(spark, rows) == plain(rows)


def test_trees_of_several_blocks(spark):
    rows = many() + [(5000 + i, "X", f"l{i}", None) for i in range(11)]
    got = found(spark, rows)
    assert got == plain(rows)
    assert {True, False} == {r[6] for r in got}


def test_one_row_is_its_own_root_and_nothing_gives_nothing(spark):
    got = found(spark, [(7, "Alone", None, None)])
    assert got == plain([(7, "Alone", None, None)])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h()
    assert found(spark, []) == []


def test_versions_share_all_nodes_off_their_path(spark):
    rows = many(700)
    docs = documents(spark, rows)
    placed = M.leaves(docs, M.tampered(), M.lowered())
    versions = M.versions(placed, M.build(placed))
    copies = M.copied_nodes(versions).collect()
    changed = versions.filter("copies[0] != leaf").collect()
    assert changed and len(copies) == sum(len(r["copies"]) for r in changed)
    base = tree([r["leaf"] for r in placed.filter("tree = '=en'").orderBy("pos").collect()])
    own = {}
    for r in copies:
        if r["tree"] == "=en":
            own.setdefault(r["version"], {})[r["level"], r["pos"]] = r["digest"]
    for version, nodes in own.items():
        # the version read through its copies, and the first version's nodes elsewhere, is a whole tree
        assert all(place == version // 8 ** level for level, place in nodes)
        for level in range(1, len(base)):
            at = version // 8 ** level
            kids = [nodes.get((level - 1, k), d) for k, d in enumerate(base[level - 1][at * 8:at * 8 + 8], at * 8)]
            assert nodes[level, at] == h(*kids) != base[level][at]
