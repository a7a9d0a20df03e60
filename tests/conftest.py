from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from runestone.session import local_session

    session = local_session(cores=8, shuffle_partitions=4, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return SMALL


@pytest.fixture(scope="session")
def corpus(spark):
    """Three languages, two labels each, twelve rows per language."""
    rows = [
        (100 * i + j, f"{lang} utterance number {j}", ["weather", "alarm"][j % 2], lang)
        for i, lang in enumerate(["en", "sv", "fi"]) for j in range(12)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, label_text string, language string").cache()
