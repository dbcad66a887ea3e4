"""The two multi-step workflows, written between steps to the shared staging folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation

from ..operators.batches import merchant_batch, pattern_batch, transaction_batch
from ..operators.cleansing import cleanse_transactions
from ..operators.decisions import (
    apply_merchant_decisions,
    apply_pattern_decisions,
    apply_transaction_decisions,
    parse_conflict_answers,
    parse_decisions,
    validate_merchant_decisions,
    validate_pattern_decisions,
    validate_recurring_decisions,
    validate_transaction_decisions,
)
from ..operators.learning import learn_all_rules
from ..operators.lifecycle import apply_fallback
from ..operators.recurring import (
    candidate_rounds,
    flag_recurring,
    harmonize_recurring,
    recurring_candidates,
    trusted_recurring_labels,
)
from ..operators.rules import apply_rules, deactivate_rules, resolve_rule_conflicts, rule_conflicts
from ..schema import is_unlabelled, prepare_rules_schema, prepare_transactions_schema
from ..sources.staging import Staging

# Takes a work batch, gives a frame with a string column ``payload`` of JSON decisions.
Labeller = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Labellers:
    """Where decisions come from, per kind of batch; a missing one skips its step.

    ``conflicts`` gets the conflicting rules, one per row, and answers which to deactivate; without it
    the best rule of each key stays.
    """

    merchants: Labeller | None = None
    patterns: Labeller | None = None
    transactions: Labeller | None = None
    recurring: Labeller | None = None
    conflicts: Labeller | None = None


@dataclass
class WorkflowResult:
    """New frames, and how many rows each step changed.

    ``transactions`` is a plan over staged tables; write it where it belongs. Counts in
    ``riding`` become known with that write.
    """

    transactions: DataFrame
    rules: DataFrame | None = None
    affected: dict[str, int] = field(default_factory=dict)
    riding: dict[str, Observation] = field(default_factory=dict)

    def affected_rows(self) -> dict[str, int]:
        """All counts; waits for the write of ``transactions``."""
        return {**self.affected, **{name: seen.get["affected"] for name, seen in self.riding.items()}}


class _Run:
    """Writes frames between steps and keeps the affected-row counts that ride on the writes."""

    def __init__(self, staging: Staging):
        self.staging = staging
        self.affected: dict[str, int] = {}

    def step(self, name: str, change: Callable[[Observation], DataFrame]) -> DataFrame:
        observation = Observation()
        table = self.staging.table(change(observation), name)
        self.affected[name] = observation.get["affected"]
        return table

    def split(self, name: str, change: Callable[[Observation], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """As ``step``, written apart: the rows that are still open, and the settled ones."""
        observation = Observation()
        tables = self.staging.split(change(observation), name, is_unlabelled())
        self.affected[name] = observation.get["affected"]
        return tables

    def decisions(self, name: str, labeller: Labeller, batch: DataFrame,
                  validate: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Ask the labeller once per batch and write its valid decisions."""
        payloads = labeller(self.staging.table(batch, f"{name}-batch")).select("payload")
        return self.staging.table(validate(parse_decisions(payloads)), f"{name}-decisions")


def resolve_conflicts(run: _Run, rules: DataFrame, as_of: Column, labeller: Labeller | None) -> DataFrame:
    """Rules without conflicts: by rank, or by the answers of ``labeller`` to the conflicting rules."""
    if labeller is None:
        return run.step("conflicts", lambda seen: resolve_rule_conflicts(rules, as_of, seen))
    payloads = labeller(run.staging.table(rule_conflicts(rules), "conflicts-batch")).select("payload")
    answers = run.staging.table(parse_conflict_answers(payloads), "conflicts-answers")
    return run.step("conflicts", lambda seen: deactivate_rules(rules, answers, as_of, seen))


def run_categorization(
    transactions: DataFrame,
    rules: DataFrame,
    as_of: Column,
    labellers: Labellers = Labellers(),
    *,
    staging: Staging | None = None,
    batch_size: int | None = None,
    include_patterns: bool = False,
    on_duplicate: str = "error",
) -> WorkflowResult:
    """Prepare, resolve conflicts, cleanse, apply rules, label by decisions, learn, fall back.

    Every labelling step is one pass over all groups; ``batch_size`` limits it to the
    most frequent ones. The raw rows are read and cleansed once and written in two
    partitions, open and settled. Each later step reads the open partition of the step
    before and rewrites only that; settled rows stay where they are.
    """
    run = _Run(staging or Staging(transactions.sparkSession))
    rules = resolve_conflicts(run, prepare_rules_schema(rules), as_of, labellers.conflicts)

    prepared = prepare_transactions_schema(transactions)
    open_rows, done = run.split("cleanse", lambda seen: cleanse_transactions(prepared, seen))
    settled = [done]
    open_rows, done = run.split("rules", lambda seen: apply_rules(open_rows, rules, as_of, staging=run.staging, observation=seen))
    settled.append(done)
    rounds = [
        ("merchants", labellers.merchants, merchant_batch, validate_merchant_decisions, apply_merchant_decisions),
        ("patterns", labellers.patterns, pattern_batch, validate_pattern_decisions, apply_pattern_decisions),
        ("transactions", labellers.transactions, transaction_batch, validate_transaction_decisions,
         apply_transaction_decisions),
    ]
    for name, labeller, batch, validate, apply in rounds:
        if labeller is None:
            continue
        found = run.decisions(name, labeller, batch(open_rows, batch_size), validate)
        open_rows, done = run.split(
            name,
            lambda seen: apply(open_rows, found, as_of, on_duplicate=on_duplicate, observation=seen),  # noqa: B023
        )
        settled.append(done)

    def together(last: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, settled, last)

    rules = learn_all_rules(
        together(open_rows), rules, as_of, include_patterns=include_patterns, staging=run.staging,
        affected=run.affected,
    )
    falling_back = Observation()
    labelled = together(apply_fallback(open_rows, as_of, falling_back))
    return WorkflowResult(labelled, rules, run.affected, {"fallback": falling_back})


def run_recurring(
    transactions: DataFrame,
    as_of: Column,
    labeller: Labeller,
    *,
    staging: Staging | None = None,
    batch_size: int | None = None,
    max_rounds: int = 50,
) -> WorkflowResult:
    """Find recurring merchants, flag their rows by the labeller's decisions, then harmonise labels.

    With ``batch_size`` the labeller is asked in rounds, most promising merchants first, until none is
    left or ``max_rounds`` are over; no merchant is offered twice. Only batches, decisions and trusted
    labels are written; when these are small, both updates are broadcast joins over one scan.
    """
    run = _Run(staging or Staging(transactions.sparkSession))
    if batch_size is None:
        found = run.decisions("recurring", labeller, recurring_candidates(transactions, None, run.staging),
                              validate_recurring_decisions)
    else:
        answers = [
            run.decisions(f"recurring-{n}", labeller, batch, validate_recurring_decisions)
            for n, batch in enumerate(candidate_rounds(transactions, batch_size, run.staging, max_rounds), 1)
        ]
        run.affected["rounds"] = len(answers)
        if not answers:
            return WorkflowResult(transactions, None, run.affected)
        found = reduce(DataFrame.unionByName, answers)
    flags, labels = Observation(), Observation()
    trusted = run.staging.table(trusted_recurring_labels(flag_recurring(transactions, found)), "trusted-labels")
    flagged = flag_recurring(transactions, found, flags)
    harmonized = harmonize_recurring(flagged, as_of, trusted=trusted, observation=labels)
    return WorkflowResult(harmonized, None, run.affected, {"flag": flags, "harmonize": labels})
