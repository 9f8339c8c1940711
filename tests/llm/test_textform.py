import unicodedata

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strandloom.llm import textform as T


def one(text):
    return T.one_form(pa.array([text], pa.string()))[0].as_py()


def test_examples():
    assert one("ｔａｌｋ  x​ ") == "talk x"
    assert one("Cοmbine numerіc ѕymbols") == "Combine numeric symbols"
    assert one("ȩ́") == one("ȩ́") == one("ȩ́")
    assert one("résumés") == "résumés" != one("resumes")
    assert one("ﬁne ﬂow") == "fine flow"
    assert one("한") == "한"
    assert one("so­ft‑ware") == "soft-ware"
    assert one("Case") != one("case")
    assert one(None) is None and one("") == "" and one(" ​　") == ""


def test_batch_equals_single_and_slices():
    texts = ["", None, "á", "x " * 5000, "ｂ", "́lone mark", "b"]
    assert T.one_form(pa.array(texts)).to_pylist() == [one(t) for t in texts]
    assert list(T.slices(pa.array(["ab", "c" * 50, "d"]), 10)) == [(0, 1), (1, 2), (2, 3)]
    assert T.one_form(pa.array(texts).slice(2, 3)).to_pylist() == [one(t) for t in texts[2:5]]
    assert T.one_form(pa.array([], pa.string())).to_pylist() == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_idempotent_and_blind_to_normal_forms(text):
    text = "".join(c for c in text if not "\ud800" <= c <= "\udfff")
    form = one(text)
    assert one(form) == form
    assert one(unicodedata.normalize("NFD", text)) == one(unicodedata.normalize("NFC", text))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abz09 -.'é", max_size=40))
def test_words(text):
    import re

    cps, offsets = T.canonical(pa.array([text, "tail"]))
    hashes, starts, ends, rows = T.words(cps, offsets)
    plain = T.to_arrow(cps, offsets).to_pylist()[0].lower()
    want = re.findall(r"[^\W_]+", plain)
    got = [plain[a:b] for a, b in zip(starts[: rows[1]], ends[: rows[1]])]
    assert got == want
    same = {w: h for w, h in zip(want, hashes.tolist())}
    assert [same[w] for w in want] == hashes[: rows[1]].tolist()
    assert len(set(same.values())) == len(same)
