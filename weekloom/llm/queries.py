"""One registered query for each operator, over its whole table, with production parameters."""

from weekloom.llm import q_documents, q_pages  # noqa: F401
from weekloom.llm.registry import ORACLES, QUERIES  # noqa: F401
