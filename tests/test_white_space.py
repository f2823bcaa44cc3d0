"""White space without patterns."""

import re

from hypothesis import given
from hypothesis import strategies as st

from docflow.markup import inline

TEXTS = st.text(st.sampled_from(" \n\t'\":#-?[]{},&*!|>%@`\\~=<0123.eYn+éß–漢\x0c\x1c\x85\xa0 　﻿😀\x07a"), max_size=25)


@given(TEXTS)
def test_white_space_is_what_patterns_take_for_it(text):
    assert inline.spaced(text) == re.sub(r"\s+", " ", text)
    assert inline.squeeze(text) == re.sub(r"\s+", " ", text).strip()
