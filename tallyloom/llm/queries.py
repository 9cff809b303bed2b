"""All queries of this subpackage; importing it registers them."""

from tallyloom.llm import (  # noqa: F401
    chat,
    debruijn,
    decontamination,
    exactdedup,
    language,
    merkle,
    minhash,
    mixing,
    pii,
    prefixtrie,
    simhash,
    toxicity,
    wavelet,
)
from tallyloom.llm.base import QUERIES, SQL  # noqa: F401
