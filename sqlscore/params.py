"""Job parameters (driver-side dataclasses).

Defaults are the values the scoring and data-preparation rules are defined
with. Fixed values that must match the original rules are grouped and marked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

# ---- fixed values (scoring rules) -------------------------------------------
SQL_KEYWORDS = ("SELECT", "FROM", "WHERE", "JOIN", "GROUP BY", "ORDER BY")
DEFAULT_WEIGHTS = (0.2, 0.6, 0.2)            # syntax, execution, semantic
SYNTAX_INVALID_SCORE = -0.5
NO_SCHEMA_SCORE = -1.0
TIMEOUT_SCORE = -0.8
EXEC_ERROR_SCORE = -0.6
REFERENCE_FAILED_SCORE = 0.3
SCORE_ON_ERROR = -1.0
SUCCESS_THRESHOLD = 0.5
PERFECT_THRESHOLD = 0.95
RUBRIC_WEIGHTS = (0.9, 0.1)                  # reward, format (XML layout on)
PROMPT_TEMPLATE = (
    "Question: {question}\n\nSchema:\n{context}\n\n"
    "Generate the SQL query to answer this question."
)
SYSTEM_PROMPT = (
    "You are a text to SQL query translator. Users will ask you questions in English "
    "and you will generate a SQL query based on the provided SCHEMA.\n\n"
    "Instructions:\n"
    "1. Analyze the schema carefully\n"
    "2. Generate syntactically correct SQL\n"
    "3. Ensure your query answers the user's question\n"
    "4. Use proper SQL formatting\n\n"
    "SCHEMA:\n{schema}"
)
XML_FORMAT_SUFFIX = (
    "\n\nOutput your response in the following format:\n"
    "<think>Your reasoning process here</think>\n"
    "<answer>Your SQL query here</answer>"
)
EMPTY_QUERY = "Empty or invalid query"
NO_SCHEMA = "No schema found"
REFERENCE_FAILED = "Reference query failed"
SQL_ERROR_PREFIX = "SQL error: "
# ChatML layout; the per-message template is a parameter of render_chat.
CHATML_MESSAGE = "<|im_start|>{role}\n{content}<|im_end|>\n"
CHATML_GENERATION_PROMPT = "<|im_start|>assistant\n"
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoreParams:
    weights: tuple[float, float, float] = DEFAULT_WEIGHTS
    # Documented intent: both spellings of a timed-out query count as timeout.
    timeout_terms: tuple[str, ...] = ("timeout", "timed out")
    keywords: tuple[str, ...] = SQL_KEYWORDS

    def __post_init__(self):
        check_weights(self.weights)


@dataclass(frozen=True)
class DataParams:
    train_size: int = 10_000
    test_size: int = 2_500
    seed: int = 42
    shuffle: bool = True


@dataclass(frozen=True)
class EvalParams:
    num_samples: int = 100
    num_generations: int = 4
    show_samples: int = 5
    success_threshold: float = SUCCESS_THRESHOLD
    perfect_threshold: float = PERFECT_THRESHOLD


def check_weights(weights, n_components: int | None = None) -> tuple[float, ...]:
    """V6: one weight per component, at least one, summing to 1; equal weights if none are given."""
    given = () if weights is None else tuple(map(float, weights))
    if weights is None and n_components:
        return (1.0 / n_components,) * n_components
    expected = len(given) if n_components is None else n_components
    if not expected or not given:
        raise ValueError("a combined score needs one or more components")
    if len(given) != expected:
        raise ValueError(f"{expected} components but {len(given)} weights")
    if not math.isclose(math.fsum(given), 1.0, abs_tol=1e-6, rel_tol=0.0):
        raise ValueError(f"the weights add up to {math.fsum(given):.6g}, not to 1")
    return given
