import pytest


@pytest.fixture(scope="session", autouse=True)
def tokenizer_threads():
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
