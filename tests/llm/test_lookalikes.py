from vaunu.llm.lookalikes import disguised, fold, proposals, to_latin

CASES = {
    "Ｌｕｌｂｒｉａ": "Lulbria", "Skändgel": "Skändgel", "Lul​bria": "Lulbria", "Drü\xa0mo": "Drü mo", "A‑B": "A-B",
    "Toﬂix": "Toflix", "\U0001d5abul": "Lul", "X²": "X²", "X™": "X™", "½": "½", "–": "–", "": "", "a  b": "a  b",
}


def test_fold():
    for text, plain in CASES.items():
        assert fold(text) == plain, text
    assert fold("می‌شود") == "می‌شود"


def test_proposals():
    assert proposals("Неmіѕ") == ["Hemis"]
    assert proposals("Щебдaрь") == ["Щебдарь"]
    assert proposals("Lulbria") == [] and proposals("Щебдарь") == [] and to_latin("Ж") is None
    assert proposals("ΧК")[-1] == "XK" and proposals("ХЕ") == ["XE"]


def test_disguised(spark):
    rows = [(i, "Hemis", "XE 90") for i in range(5)] + [(20, "Uſva", "Heᴍis"), (21, "ꓧemiꓢ", "Ĳsel")] + [
        (10, "Неmіѕ", "ΧЕ 90"), (11, "Щебдарь", "Щебдaрь"), (12, None, ""), (13, "ХЕ", "Сор"), (14, "Ｑix " * 5000, "Xѕq"),
    ]
    df = spark.createDataFrame(rows, "item_no long, brand string, model string")
    got = {(r.item_no, r.field): r.unified for r in disguised(df, "item_no", ["brand", "model"]).collect()}
    assert got == {
        (20, "brand"): "Usva", (20, "model"): "Hemis", (21, "brand"): "HemiS", (21, "model"): "IJsel", (10, "brand"): "Hemis", (10, "model"): "XE 90", (11, "model"): "Щебдарь", (13, "brand"): "XE", (14, "brand"): "Qix " * 5000,
    }
    assert disguised(df.limit(0), "item_no", ["brand"]).collect() == []
