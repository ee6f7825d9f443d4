"""Word usage across topics over time, as PySpark DataFrame functions."""

from termflow.plans.comment_tokens import comment_tokens, comment_words
from termflow.plans.file_audit import audit_files
from termflow.plans.job import JobSettings, run_job
from termflow.plans.topic_map import build_topic_map
from termflow.plans.word_statistics import comment_statistics, word_statistics
from termflow.operators.trending import trending_terms
from termflow.session import build_session

__all__ = [
    "JobSettings",
    "audit_files",
    "build_session",
    "build_topic_map",
    "comment_statistics",
    "comment_tokens",
    "comment_words",
    "run_job",
    "trending_terms",
    "word_statistics",
]
