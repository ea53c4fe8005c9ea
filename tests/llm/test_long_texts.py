"""Texts that are longer than what a packed number holds."""

import numpy as np

from topicloom.llm import substrings


def test_anchors_past_2_to_the_24_words():
    passage = b" ".join(b"p%d" % k for k in range(80))
    text = b" ".join([passage, b"a " * (1 << 24), passage])
    p = substrings.Parsed([text], substrings.WINDOW, substrings.GRAM)
    far = p.start > (1 << 24)
    inside = (p.start > 0) & (p.start + p.size + substrings.WINDOW <= 80)
    assert inside.sum() > 1
    assert np.isin(p.anchor[inside], p.anchor[far]).all() and np.isin(p.phrase[inside], p.phrase[far]).all()
