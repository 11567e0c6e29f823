"""Prepare and score language-model tuning data on Spark."""

from tunedata.functions.chat import bare_prompt, chat_prompt, messages, sft_text
from tunedata.functions.corrupt import rejected_variant
from tunedata.functions.fences import (
    has_html_block,
    has_python_block,
    html_blocks,
    is_valid_html,
    python_blocks,
)
from tunedata.functions.reward import (
    Checks,
    breakdown_text,
    compute_reward,
    explain_reward,
    is_compliant,
    reward_function,
    reward_names,
    with_breakdown,
    with_reward,
    with_rewards,
)
from tunedata.functions.syntax import is_valid_python
from tunedata.functions.tags import (
    code_blocks,
    has_code_block,
    has_info_block,
    info_blocks,
    info_length_ok,
)
from tunedata.operators.limits import first_n
from tunedata.operators.metrics import (
    compute_metrics,
    html_valid_rate,
    metrics_report,
    syntax_rate,
)
from tunedata.operators.pairs import informative_pairs, pair_report, require_columns
from tunedata.operators.rollouts import (
    evaluation_requests,
    group_relative,
    prompt_table,
    rollout_requests,
    score_rollouts,
)
from tunedata.operators.syntax import python_validity
from tunedata.plans.evaluate import evaluate_responses
from tunedata.plans.prepare import prepare_datasets
from tunedata.plans.preference import load_preference_pairs
from tunedata.sources.jsonl import (
    located_lines,
    read_jsonl,
    read_jsonl_tolerant,
    read_quarantine,
    read_training_set,
)
from tunedata.streaming.monitor import (
    compact_reward_windows,
    late_rows,
    read_reward_windows,
    reward_windows,
    start_reward_monitor,
)

__all__ = [name for name in dir() if not name.startswith("_")]
