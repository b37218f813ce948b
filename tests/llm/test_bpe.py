import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagwise.llm import bpe
from tagwise.sources.tables import table
from tests.llm import helpers as H

PATH = bpe.public_path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def brute(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    text = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def check(spark, folder, library):
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op6_bpe_encode_decode(spark, folder).collect())
    assert got == sorted((str(r.doc_id), *brute(library, r.text)) for r in table(spark, folder, "documents").collect())


def test_edge_cases_match_the_library(spark, scratch, library):
    rows = H.doc_rows()
    odd = ["<|startoftext|>a<|endoftext|>", "á ẹ́ 각", "İSTANBUL ΑΣ ς ﬀ ½ ²", "it's 'S !!'re\t\x1c\x85\xa0x", "中文字符 кириллица", "a b"]
    rows += [(10_000 + i, t, None, None, None, None, None) for i, t in enumerate(odd)]
    rng = random.Random(4)
    rows += [(20_000, "".join(rng.choice("abcdeéx'!.1") for _ in range(40_000)), None, None, None, None, None)]
    rows += [(20_001, ("ab" * 9000 + " <|endoftext|>") * 3, None, None, None, None, None)] * 2
    check(spark, H.sf_dir(spark, scratch, documents=(rows, H.DOC_SCHEMA)), library)


def test_documents_match_the_library(spark, library):
    check(spark, "/root/testdata/sf0.001", library)


def test_empty_table(spark, scratch):
    assert bpe.op6_bpe_encode_decode(spark, H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA))).collect() == []


def tree(text, leaves):
    n = len(text)
    cuts = [n * i // leaves for i in range(leaves + 1)]
    return np.frombuffer(bpe.concat_tree(PATH, [bpe.encode_leaf(PATH, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]), "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_tree_concatenation_is_exact_wherever_it_cuts(library, data):
    alphabet = data.draw(st.sampled_from(["ab", "aaaaab", "etaoin", "the 's!'re", "é̃aA ", "!'s?.", "日本語x", "<|endoftext|> ", "abcdefghijklmnopqrstuvwxyz"]))
    text = data.draw(st.text(alphabet=alphabet, min_size=1, max_size=600)) * data.draw(st.integers(1, 4))
    assert tree(text, data.draw(st.sampled_from([2, 4, 8]))) == library.encode(text, add_special_tokens=False).ids


def test_long_unsplit_text(library):
    rng = random.Random(8)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", "lo", "!?.", "é", "interationsh"):
        text = "".join(rng.choice(alphabet) for _ in range(12_000))
        assert tree(text, 8) == library.encode(text, add_special_tokens=False).ids


def test_seams_are_joined_by_small_windows(monkeypatch):
    """On ordinary long words the window does not grow to the whole of both sides."""
    rng = random.Random(9)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(8000))
    x, y = bpe.encode_chunk(PATH, text[:4000]), bpe.encode_chunk(PATH, text[4000:])
    sizes, plain = [], bpe.encode_chunk
    monkeypatch.setattr(bpe, "encode_chunk", lambda p, c: (sizes.append(len(c)), plain(p, c))[1])
    joined = bpe.concat_parts(PATH, x, y)
    assert max(sizes) < 1000
    assert joined[1].tolist() == plain(PATH, text)[1].tolist() and joined[2].tolist() == plain(PATH, text)[2].tolist()
