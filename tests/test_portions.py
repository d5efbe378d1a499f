"""Foreign extractors get few rows at a time, and every row once."""

import pandas as pd

from attestry.operators import external


def test_extractor_gets_portions_with_every_row_once():
    frames = [pd.DataFrame({"page_number": range(n)}) for n in (0, 2500, 1000)]
    got = list(external.portions(iter(frames)))
    assert [len(frame) for frame in got] == [1000, 1000, 500, 1000]
    assert pd.concat(got).page_number.tolist() == [*range(2500), *range(1000)]
