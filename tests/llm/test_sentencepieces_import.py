import sys

import pytest

from corefold.llm import sentencepieces as sp
from corefold.llm.queries import TOKENIZER


def test_a_missing_library_is_no_silent_skip(monkeypatch):
    data = sp.read_model(TOKENIZER)
    monkeypatch.setitem(sys.modules, "sentencepiece", None)
    with pytest.raises(ImportError):
        sp.Codec(data)
    assert sp.Codec(data, parity=False).verified(["a b"], False)[0][1] is None
