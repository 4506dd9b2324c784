from vaunu.llm.reference_map import Mapper, Trie, budget, map_entries

REFS = [(1, "Skändgel", "Kesskix 60"), (2, "Skändgel", "M90"), (3, "Miskene-Bosskene", "Hekra 10"), (4, "Miskene-Bosskene", "Truno"), (5, "Lulbria", "Sibrura"), (6, "Lulbria", "Sibrura 20")]
CASES = [
    ("Skändgel", "Kesskix 60", 1), ("Sknädgel", "Skändgel M90", 2), ("Skaendgel Oy", "kesskix_60", 1), ("MB", "Hekra 10", 3), ("M-B", "TRUNO", 4),
    ("Bosskene Miskene", "Tuno", 4), ("Miskene-Boss.", "Hekra 10 4x4", 3), ("M. BOSSKENE", "Truno", 4), ("Lulbria", "Sibrura 20 Combi", 6),
    ("lULBRIA", "Sibrura", 5), ("Sibrura", "Lulbria", 5), ("Skändgel", "Kesskix 90", 0), ("Lulbria", "Kesskix 60", 0), ("???", "M90", 0),
    ("Ｌｕｌｂｒｉａ", "Ѕіbrurа", 5), ("x" * 30_000, "M90", 0), ("Lulbria", "Sibruraxyz", 0),
]


def edits(a, b):
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_brute_force():
    words = ["abcd", "abdc", "bacd", "abc", "xabcd", "abxcd", "acbd", "zzzz", "ab", "", "abcdabcd"]
    trie = Trie()
    for i, w in enumerate(words):
        trie.add(w, i)
    for text in ["abcd", "", "acd", "badc", "abcdabc"]:
        for most in range(4):
            assert trie.search(text, most) == {i: edits(text, w) for i, w in enumerate(words) if edits(text, w) <= most}
    assert trie.begins("abc") == {0, 3, 10} and budget(3) == 0


def test_cases():
    mapper = Mapper(REFS)
    for brand, model, want in CASES[:-2]:
        assert next((r for _, _, r in mapper.map(brand, model)), 0) == want, (brand, model)
    # a long text is searched whole
    assert mapper.map("Lulbria", "Sibrura 20" + " sedan" * 2000)[0] == (0, 0, 6) and mapper.map("Lulbria" + " oy" * 2000, "-" * 50_000 + "Sibrura")[0] == (0, 0, 5)
    assert mapper.map("Lulbria", "Sibrur") == ((1, 0, 5),)


def test_map_entries(spark):
    rows = [(i, b, m, 7) for i, (b, m, _) in enumerate(CASES)] + [(100, None, "M90", 7), (101, " ", "M90", 7), (102, "Lulbria", " ", 7)]
    entries = spark.createDataFrame(rows, "entry_no long, brand string, model string, ref_id int")
    references = spark.createDataFrame([*REFS, (9, None, "x")], "ref_id long, brand string, model string")
    assert {r.entry_no: r.ref_id for r in map_entries(entries, references).collect()} == {i: w for i, (_, _, w) in enumerate(CASES)}
    blocks = map_entries(entries, references, most=2)  # a list longer than may go out at once
    assert {r.entry_no: r.ref_id for r in blocks.collect()} == {i: w for i, (_, _, w) in enumerate(CASES)}
    assert {r.ref_id for r in map_entries(entries, references.limit(0)).collect()} == {0}
    assert map_entries(entries.limit(0), references).collect() == []
