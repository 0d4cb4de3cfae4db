import random

from molarflow.llm import lines as L


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_recurring_lines_stay_in_the_first_document_only(docs_of):
    same = "this line stands in many documents word for word"
    out = texts_of(L.drop_recurring(docs_of([f"own text number one of a\n{same}", same, f"{same}\n{same}\nshort", "short"]).coalesce(1)))
    assert out == {0: f"own text number one of a\n{same}", 1: "", 2: "short", 3: "short"}


def test_variable_fields(docs_of):
    d = docs_of(["User 17 logged in from 10.0.0.1 today", "User 4711 logged in from 10.9.8.7 today",
                 "User nobody logged in from somewhere today"]).coalesce(1)
    assert texts_of(L.drop_recurring(d)) == {0: "User 17 logged in from 10.0.0.1 today", 1: "",
                                            2: "User nobody logged in from somewhere today"}
    words = [f"w{chr(97 + i)}" for i in range(20)]
    changed = words[:10] + ["other"] + words[11:]
    far = words[:5] + [f"z{chr(97 + i)}" for i in range(15)]
    d = docs_of([" ".join(words), " ".join(changed), " ".join(far)]).coalesce(1)
    assert texts_of(L.drop_recurring(d)) == {0: " ".join(words), 1: "", 2: " ".join(far)}


def test_edge_cases(docs_of):
    d = docs_of([(1, None), (2, ""), (3, "\n\n"), (4, "a b c d e f"), (4, "a b c d e f")]).coalesce(1)
    out = L.drop_recurring(d, n_dropped="gone")
    assert out.columns == [*d.columns, "gone"]
    assert sorted((r.doc_id, r.text or "", r.gone) for r in out.collect()) == [
        (1, "", 0), (2, "", 0), (3, "\n\n", 0), (4, "", 1), (4, "a b c d e f", 0)]
    assert L.drop_recurring(docs_of([])).count() == 0


def test_leaf_equals_exhaustive_search():
    """The segment index finds the same template as comparing with all of them."""
    r = random.Random(1)

    class Plain(L.Leaf):
        def __init__(self, n):
            super().__init__(n)
            self.segments = [(0, 0)]  # one empty segment that everything shares

    for n in (2, 6, 11, 16):
        a, b = L.Leaf(n), Plain(n)
        base = [[r.randrange(9) for _ in range(n)] for _ in range(8)]
        for t in range(300):
            sig = [x if r.random() < 0.9 else r.randrange(9, 99) for x in r.choice(base)] + [0] * (16 - n)
            for leaf in (a, b):
                leaf.add(t, sig, t, t)
        assert a.members == b.members and a.tokens == b.tokens


def test_long_text(docs_of):
    many = "\n".join(f"line of words {chr(97 + i % 26)} {chr(97 + i // 26 % 26)} {chr(97 + i // 676)}" for i in range(3000))
    d = docs_of([many, many]).coalesce(1)
    out = texts_of(L.drop_recurring(d))
    assert out[0] == many and out[1] == ""


def test_short_lines_and_scripts_without_spaces(docs_of):
    notice, chinese = "All rights reserved.", "\u672c\u7f51\u7ad9\u7248\u6743\u6240\u6709\u8bf7\u52ff\u8f6c\u8f7d"
    d = docs_of([f"{notice}\n{chinese}\nPage 1 of 9\n* * *", f"{notice}\n* * *\nAll rights waived.",
                 f"{chinese}\nPage 7 of 9", f"{chinese[:5]}\nPage one of 9"]).coalesce(1)
    assert texts_of(L.drop_recurring(d)) == {0: f"{notice}\n{chinese}\nPage 1 of 9\n* * *", 1: "* * *\nAll rights waived.",
                                            2: "", 3: f"{chinese[:5]}\nPage one of 9"}


def test_long_lines_are_compared_on_every_token(docs_of):
    """Lines that agree at 16 evenly spaced places only are told apart; a line edited at these places is not."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(203)]
    places = {3 + i * 200 // 16 for i in range(16)} | {0, 1, 2}
    other = [w if i in places else word() for i, w in enumerate(base)]
    near = [word() if i in places and i > 2 else w for i, w in enumerate(base)]
    texts = [" ".join(x) for x in (base, other, near)]
    out = texts_of(L.drop_recurring(docs_of(texts).coalesce(1)))
    assert out == {0: texts[0], 1: texts[1], 2: ""}
