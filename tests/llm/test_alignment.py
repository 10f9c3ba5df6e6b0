import hashlib
from array import array
from bisect import bisect_right
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sentimill.llm import alignment as al

NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SOME = st.lists(st.sampled_from(["<|endoftext|>", "</s>", "<0x41>", " ", "  ", "\n", "\t", "\r", " \r", "▁", "é", "漢", "🙂", "word",
                                 "'re", "\x00", "\x1c", " ", " ", "ﬁ", "x\n  y", "123", "...", "a"])).map("".join)


@pytest.fixture(scope="module")
def own():
    return al.Aligner(al.model_path(al.MODEL_A), al.model_path(al.MODEL_B))


class Plain:
    """The contract said plainly: whole texts, the libraries, offsets in sets."""

    def __init__(self):
        self.a = Tokenizer.from_file(al.model_path(al.MODEL_A))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=al.model_path(al.MODEL_B))
        signs = {}
        extra = 256
        for byte in range(256):
            if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
                signs[chr(byte)] = byte
            else:
                signs[chr(extra)] = byte
                extra += 1
        self.signs = signs

    def spell_a(self, i):
        return bytes(self.signs[c] for c in self.a.id_to_token(i))

    def spell_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        sides = []
        for ids, spell in ((a, self.spell_a), (b, self.spell_b)):
            if b"".join(map(spell, ids)) != (" " + text).encode():
                return []
            at, ends = 0, []
            for i in ids:
                at += len(spell(i))
                ends.append(at)
            sides.append((ids, ends))
        (_, ends_a), (_, ends_b) = sides
        cuts = sorted({*ends_a} & {*ends_b})
        return [tuple(ids[bisect_right(ends, low):bisect_right(ends, high)] for ids, ends in sides)
                for low, high in zip([0, *cuts], cuts)]

    def rows(self, docs):
        found = [(doc_id, self.groups(text)) for doc_id, text in docs]
        count = Counter((x[-1], y[-1]) for _, groups in found for x, y in groups)
        best = {}
        for (_, b), n in count.items():
            best[b] = max(best.get(b, 0), n)
        out = Counter()
        for doc_id, groups in found:
            links = [(x[-1], y[-1]) for x, y in groups]
            line = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            out[doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(line.encode()).hexdigest() if groups else ""] += 1
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


@settings(max_examples=300, deadline=None)
@given(st.lists(SOME | st.text(max_size=30), min_size=1, max_size=4))
def test_texts_equal_the_whole_encoding(own, plain, texts):
    for text, found in zip(texts, own.texts(texts)):
        groups = plain.groups(text)
        line = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        assert found[:3] == (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups))
        assert found[3] == (hashlib.sha256(line.encode()).hexdigest() if groups else "")


def test_tokens_that_never_end_together_share_a_group(own, monkeypatch):
    def groups(a, b, bytes_a, bytes_b):
        monkeypatch.setattr(own, "lengths_a", list(map(len, bytes_a)))
        monkeypatch.setattr(own, "lengths_b", list(map(len, bytes_b)))
        line, links = own.align(a, b)
        return line.decode(), [divmod(x, own.size_b) for x in array("I", links)]

    assert groups([0, 1], [0, 1], [b"ab", b"cd"], [b"abc", b"d"]) == ("0,1|0,1", [(1, 1)])
    assert groups([0, 0], [1, 0], [b"ab"], [b"aba", b"b"]) == ("0,0|1,0", [(0, 0)])
    assert groups([0, 1], [0, 1], [b"a", b"b"], [b"a", b"b"]) == ("0|0;1|1", [(0, 0), (1, 1)])
    assert groups([0], [0, 0, 1], [b"abc"], [b"a", b"c"]) == ("0|0,0,1", [(0, 1)])


def got(df):
    assert df.columns == list(NAMES)
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("most", [al.MOST_PAIRS, 3, 0], ids=["all broadcast", "some broadcast", "none broadcast"])
def test_odd_documents(odd_docs, odd_rows, plain, most):
    assert got(al.align_documents(odd_docs, most=most)) == plain.rows([(r.doc_id, r.text) for r in odd_rows])


def test_copies_weigh_as_often_as_they_occur(spark, plain):
    rows = [(i, "the same text, often") for i in range(700)] + [(1000 + i, f"text {i} ▁" if i % 5 == 0 else f"text {i}") for i in range(60)]
    rows += [(5000, " ".join(f"w{i % 977}" for i in range(40_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(al.align_documents(df, most=50)) == plain.rows(rows)


def test_no_documents(no_docs):
    assert al.align_documents(no_docs).collect() == []


def test_a_worker_remembers_so_much(own, plain, monkeypatch):
    monkeypatch.setattr(al, "KNOWN", len(own.number) + 7)
    for k in range(10):
        texts = [f"some words {k} and {k * j} more ▁{j}" if j % 4 else "w" * 99 for j in range(20)]
        assert [f[2] for f in own.texts(texts)] == [len(plain.groups(t)) for t in texts]
    assert len(own.number) == al.KNOWN == len(own.groups) == len(own.links)
