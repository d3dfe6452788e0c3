"""accmine: mining accession-id mentions from article collections on Spark."""

from .operators.mine import AccessionPattern, extract_mentions, findings_from_mentions, mine_text  # noqa: F401
from .session import build_session, scratch_path  # noqa: F401

__version__ = "0.1.0"
