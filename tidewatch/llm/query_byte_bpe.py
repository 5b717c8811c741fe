from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .book import query, table
from .byte_bpe import decode, encode


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    """Digest of the ids and of the decoded bytes of every document."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, ranks, pattern).select("doc_id", "n_tokens", "ids")
    decoded = decode(encoded, ranks, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
