from __future__ import annotations

from .book import query, table
from .main_text import extract


@query("op8_text_density")
def op8_text_density(spark, sf_dir):
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
