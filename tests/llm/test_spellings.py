import itertools
import random

from vaunu.llm import spellings
from vaunu.llm.spellings import RADIUS, distance, edits, makers, near, read, same_maker_pairs, tell_apart

READ = {
    "Michael Lipaho-Nimhaksil Karosseri Ab": ("michael", "karosseri", "lipaho", "nimhaksil"),
    "Trlrs T. Femefa-Rirsiltek Kft": ("t", "trailers", "femefa", "rirsiltek"),
    "fiirafu-gersilhor, alexander automobili d.o.o.": ("alexander", "automobili", "fiirafu", "gersilhor"),
    "Bipi. Ranpushom Spec. Veh.": ("", "special vehicles", "bipi.", "ranpushom"),
    "A/S H. GopileFuntetnak Mot. Co.": ("h", "motor company", "funtetnak", "gopile"),
    "pomugutemnakfak": ("", "", "pomugutemnakfak", ""),
    "Tuntematon": None, "??": None, "": None, "muu merkki": None, "Oy": None,
}


def test_read():
    for text, want in READ.items():
        assert read(text) == want, text


def test_tree_equals_all_pairs():
    random.seed(3)
    base = ["lipaho", "nimhaksil", "kokido"]
    names = {tuple(sorted((typo(random.choice(base)), typo(random.choice(base))))) for _ in range(120)} | {("lip.", "nimhaksil"), ("lipahonimhaksil", ""), ("lipaho", "nimh."), ("lipahonimhaksl", "")}
    names = sorted(names)
    got = {(min(i, j), max(i, j)): d for i, j, d in near(names)}
    cut = {i for i, n in enumerate(names) if n[0].endswith(".") or n[1].endswith(".")}
    want = {(i, j): d for i, j in itertools.combinations(range(len(names)), 2) if (d := distance(names[i], names[j])) <= (0 if {i, j} <= cut else RADIUS)}
    assert got == want


def typo(word):
    for _ in range(random.randrange(3)):
        i = random.randrange(len(word))
        word = word[:i] + random.choice(["", word[i] * 2, "x"]) + word[i + 1 :]
    return word


def test_distance():
    assert edits("abcd", "abdc", 2) == 1 and edits("ca", "abc", 3) == 2 and edits("abc", "abc", 0) == 0
    assert edits("abc", "abd", 2) == 1 and edits("abc", "xyz", 2) == 3 and edits("", "ab", 2) == 2
    assert distance(("a", "bcd"), ("bcd", "a")) == 0 and distance(("lip.", "xyz"), ("lipaho", "xyz")) == 0


def test_tell_apart():
    assert tell_apart([("robert", "x", 3), ("r", "x", 1), ("", "x", 1), ("robert", "", 1)]) == [0, 0, 0, 0]
    a, b, c = tell_apart([("robert", "x", 3), ("richard", "x", 2), ("r", "x", 1)])
    assert a != b and c == a


def test_pairs(spark):
    rows = [
        (1, "Robert Lipaho-Nimhaksil Karosseri Ab"), (2, "BOB LIPAHO NIMHAKSIL KAROSS."), (3, "Nimhakksil-Lipaho, R. Karosseri"), (4, "Robert Lipa. Nimhaksil"),
        (5, "Richard Lipaho-Nimhaksil Karosseri"), (6, "Robert Lipaho-Nimhaksil Caravans"), (7, None), (8, "-"), (9, "Tuntematon"), (10, "Tuntematon"),
        (11, "Kokido-Vondekvas Cvns"), (12, "KokidoVondékvas"), (13, "Kokido-Vondekvas Caravans"), (14, "y" * 5000), (15, " "),
        (21, "Haha. Hussoktek Trailers"), (22, "Hahaki Hussok. Trl."),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "entry_id long, brand string, name string, family int")
    got = {tuple(r) for r in same_maker_pairs(df).collect()}
    assert got == set(itertools.combinations([1, 2, 3, 4], 2)) | set(itertools.combinations([11, 12, 13], 2)) | {(21, 22)}
    assert same_maker_pairs(df.limit(0)).collect() == []


def test_hot_maker(spark):
    random.seed(1)
    rows = [(i, f"Robert {typo('lipaho')}-Nimhaksil") for i in range(600)] + [(1000 + i, f"Robert Ken{chr(97 + i % 26)}{chr(97 + i // 26)}ozu-Valdertam") for i in range(100)]
    got = makers(spark.createDataFrame(rows, "entry_id long, brand string")).collect()
    hot = {(r.family, r.maker) for r in got if r.entry_id < 1000}
    assert len(got) == 700 and len(hot) <= 4


def test_a_hot_maker_is_salted_and_stays_whole(spark, monkeypatch):
    monkeypatch.setattr(spellings, "SHARE", 7)
    rows = [(i, "Nimhaksil Trailers" if i % 3 else "Lipaho Trailers") for i in range(60)]
    df = spark.createDataFrame(rows, "entry_id long, brand string")
    got = sorted(map(tuple, spellings.same_maker_pairs(df).collect()))
    assert got == [(a, b) for a, x in rows for b, y in rows if a < b and x == y]


def named(names):
    return [("-".join(p for p in n if p), *n, 1) for n in names]


def test_links_are_all_pairs_within_the_radius(spark, monkeypatch):
    """Cells of parts, guests, one word and cut names together against brute force, in one piece and divided."""
    random.seed(8)
    base = [("lipaho", "nimhaksil"), ("lipuho", "nimhaksul"), ("kokido", "nimhaksil"), ("lipaho", "vondekvas")]
    names = {tuple(sorted(typo(p) for p in random.choice(base))) for _ in range(90)}
    names |= {("".join(typo(p) for p in random.choice(base)), "") for _ in range(25)} | {("lipahnoimhaksl", ""), ("nimhaksillipaho", ""), ("y" * 60, ""), ("y" * 59, "")}
    names |= {tuple(sorted((random.choice(["lip.", "lipa.", "ilpa."]), typo("nimhaksil")))) for _ in range(15)} | {("lipaho", "nimh."), ("lip.", "nixxaksil")}
    names = sorted(names)
    df = spark.createDataFrame(named(names), "name string, a string, b string, n long")
    want = {(x, y) for (x, p), (y, q) in itertools.combinations([(r[0], r[1:3]) for r in named(names)], 2) if distance(p, q) <= (0 if spellings._cut(p) and spellings._cut(q) else RADIUS)}
    lost = {n[0] for n in named(names) if spellings._cut(n[1:3])}
    for cell in (256, 5):
        monkeypatch.setattr(spellings, "CELL", cell)
        got = {tuple(sorted((r.x, r.y))): r.d for r in spellings.linked(df).collect()}
        assert set(got) <= {tuple(sorted(w)) for w in want}
        # a cut name goes to its nearest, so that those farther are not needed where one is within 1
        best = {c: min([d for p, d in got.items() if c in p and not set(p) <= lost], default=9) for c in lost}
        missing = {tuple(sorted(w)) for w in want} - set(got)
        assert all(len(set(p) & lost) == 1 and best[(set(p) & lost).pop()] < 2 for p in missing), missing


def test_cells_do_not_grow_with_the_square(spark):
    """Names of unrelated makers are guests of few cells: by the longer part only, and at home in their own."""
    names = named([(a + b + c, f"{x}hak{y}") for a, b, c, x, y in itertools.product(["li", "lu", "lo", "le"], ["pa", "pi", "pu", "po"], ["ho", "hu"], ["nim", "dul"], ["sil", "tek"])])
    df = spark.createDataFrame(names, "name string, a string, b string, n long")
    rows = spellings._placed(df).groupBy("guest").count().collect()
    assert {r.guest: r["count"] for r in rows} == {False: 2 * len(names)}


def test_within_one():
    words = ["", "a", "ab", "ba", "abc", "acb", "bca", "abcd", "abdc", "bcda", "axcd"]
    assert all(spellings.within_one(a, b) == (edits(a, b, 1) <= 1) for a in words for b in words)


def test_tree_of_a_large_cell(monkeypatch):
    monkeypatch.setattr(spellings, "CELL", 24)
    test_tree_equals_all_pairs()
