from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .book import query, table
from .token_files import read, store

END = 2


@query("op7_huffman_token_files")
def op7_huffman_token_files(spark, sf_dir):
    """Place, size and checksum of every document's ids, from files written and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = store(docs, public_tokenizers.path("byte_bpe_50k.json"), END)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
