import os

import pytest


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    from stratum.llm.common import workers_import
    workers_import(spark)
    return os.environ
