"""One registered query per operator, over whole tables with production parameters."""

from . import query_byte_bpe, query_conversation_repair, query_decision_list, query_decontaminate, query_license_scan, query_main_text, query_personal_data, query_quality, query_ranked_search, query_secrets, query_shingle_join, query_source_mix, query_token_files  # noqa: F401
from .book import BOOK

__all__ = ["BOOK"]
