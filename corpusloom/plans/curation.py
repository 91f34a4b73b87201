"""The curation pipeline: clean, split, queue, generate, filter, de-duplicate, judge twice, agree, select, seal and audit.

Stages are Parquet tables below one folder, partitioned by split; model records are appended and never made twice. The
configuration is a JSON object (its keys are those of CONFIG below); rows carry its hash, and a stage refuses rows of another.
What a stage brings to the driver is bounded by quotas and the number of sources.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import prompts
from corpusloom.functions import text as T
from corpusloom.operators import audit, consensus, dedup, gates, generation, selection
from corpusloom.sources import sinks

SPLITS = ("train", "validation", "test", "challenge")
PASSES = ("rubric", "adversarial")
#: Precedence of global de-duplication.
PRECEDENCE = ("challenge", "test", "validation", "train")
CONFIG = {
    "pipeline_version": str, "sft_version": str, "benchmark_version": str, "seed": int, "validation_sources": list, "test_sources": list, "final_quotas": dict,
    "initial_candidate_multiplier": float, "max_attempts": dict, "candidate_source_caps": dict, "final_source_caps": dict, "cleaning": dict, "hard_filter": dict,
    "generation": dict, "judge": dict,
}


class Curation:
    def __init__(
        self, spark: SparkSession, config: Mapping, root: str, generator: Callable[[], generation.Backend] | None = None,
        judge: Callable[[], generation.Backend] | None = None, now: Callable[[], str] | None = None,
    ):
        """root: a folder that driver and executors share; generator and judge: factories of backends, called in each task."""
        if missing := sorted(set(CONFIG) - set(config)):
            raise ValueError(f"configuration lacks {missing}")
        self.spark, self.config, self.root = spark, dict(config), root.rstrip("/")
        self.generator, self.judge_factory = generator, judge
        self.hash = audit.canonical_sha256(self.config)
        self.now = now or (lambda: datetime.now(UTC).isoformat())
        self.manifest: dict | None = None
        self.schemas: dict = {}

    # --- tables --------------------------------------------------------------------------------------------------------

    def path(self, stage: str) -> str:
        return f"{self.root}/{stage}"

    def has(self, stage: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(stage))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def read(self, stage: str, split: str | None = None) -> DataFrame:
        reader = self.spark.read.schema(self.schemas[stage]) if stage in self.schemas else self.spark.read
        rows = reader.parquet(self.path(stage))
        return rows if split is None else rows.where(F.col("split") == split)

    def _write(self, df: DataFrame, stage: str, mode: str = "overwrite") -> None:
        # no file is written for no row, so the schema is kept for reading
        self.schemas[stage] = df.schema
        df.write.mode(mode).partitionBy("split").parquet(self.path(stage))

    def _counts(self, stage: str) -> dict[str, int]:
        return {r[0]: r[1] for r in self.read(stage).groupBy("split").count().collect()} if self.has(stage) else {}

    # --- corpus --------------------------------------------------------------------------------------------------------

    def clean(self, raw: DataFrame) -> dict:
        """raw: text, source_file, paragraph_index and line_no. Accepted rows go to corpus, others to clean_rejections."""
        c = self.config["cleaning"]
        rules = gates.CleaningRules(c["min_chars"], c["max_chars"], c["min_alphabetic_ratio"], c["repeated_ngram_size"], c["repeated_ngram_count"])
        rows = raw.withColumn("source_file", F.when(F.col("paragraph_index").isNotNull(), F.col("source_file")))
        rows = gates.clean_corpus(rows, rules, "text", "source_file", "line_no")
        name = F.concat_ws(":", F.col("source_file"), F.col("paragraph_index").cast("string"), F.col("cleaned_text"))
        rows = rows.select(
            T.fingerprint(name).alias("paragraph_id"), "source_file", F.col("paragraph_index").cast("bigint").alias("paragraph_index"), F.col("text").alias("raw_text"),
            "cleaned_text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("raw_sha256"), F.col("operations").alias("cleaning_operations"),
            F.col("line_no").alias("input_line"), F.col("reasons").alias("rejection_reasons"), F.lit(self.hash).alias("config_hash"),
        )
        # whole rows are computed once; both tables are read from what was written
        rows.write.mode("overwrite").parquet(self.path("cleaned"))
        rows = self.spark.read.parquet(self.path("cleaned"))
        good, bad = gates.split_by(rows, "rejection_reasons")
        counts = {r["reason"]: r["n"] for r in gates.reason_counts(rows, "rejection_reasons").collect()}
        return {"accepted": good.count(), "rejected": bad.count(), "rejection_counts": dict(sorted(counts.items()))}

    @property
    def corpus(self) -> DataFrame:
        return gates.split_by(self.spark.read.parquet(self.path("cleaned")), "rejection_reasons")[0]

    def split(self, expected: tuple[int, int, int] | None = None) -> dict:
        c = self.config
        self.manifest = selection.split_manifest(self.corpus, c["validation_sources"], c["test_sources"], "source_file", expected)
        self.manifest["config_hash"] = self.hash
        one = self.spark.createDataFrame([(json.dumps(self.manifest),)], "value string")
        one.coalesce(1).write.mode("overwrite").text(self.path("split_manifest"))
        return self.manifest

    def sources(self, split: str) -> list[str]:
        if self.manifest is None:
            self.manifest = json.loads(self.spark.read.text(self.path("split_manifest")).first()[0])
        if self.manifest["config_hash"] != self.hash:
            raise ValueError("the split manifest is of another configuration")
        return self.manifest["splits"][split]

    def quotas(self, split: str, initial: bool = False) -> dict[str, int]:
        more = self.config["initial_candidate_multiplier"] if initial else 1
        return {k: round(n * more) for k, n in self.config["final_quotas"][split].items()}

    # --- queue ---------------------------------------------------------------------------------------------------------

    def queue(self, split: str, requested: Mapping[str, int] | None = None, preferred: Sequence[str] = (), partial: bool = False) -> dict:
        """Add contexts for the requested types to the split's queue; a context is used once over all splits."""
        asked = dict(requested or self.quotas(split, initial=True))
        kinds = selection.CHALLENGE_TYPES if split == "challenge" else selection.REGULAR_TYPES
        if unknown := sorted(set(asked) - set(kinds)):
            raise ValueError(f"types {unknown} are none of {split}")
        if outside := sorted(set(preferred) - set(self.sources(split))):
            raise ValueError(f"sources {outside} are outside {split}")
        before = self.read("queues", split).groupBy("source_file", "config_hash").count().collect() if self.has("queues") else []
        if any(r["config_hash"] != self.hash for r in before):
            raise ValueError("the queue is of another configuration")
        loads = Counter({r["source_file"]: r["count"] for r in before})
        room = self.config["max_attempts"][split] - sum(loads.values())
        if sum(asked.values()) > room and not partial:
            raise RuntimeError(f"{split} would exceed its most attempts")
        cap, added, short = self.config["candidate_source_caps"][split], 0, {}
        rows = self.corpus.where(F.col("source_file").isin(self.sources(split)))
        for kind, target in asked.items():
            allowed = max(0, min(target, room - added))
            got = []
            if allowed:
                pick = self._pairs if kind == "cross_concept" else self._singles
                contexts = pick(rows, kind, allowed, cap, loads, preferred)
                new = selection.candidate_rows(contexts, split, kind, self.hash, self.config["generation"]["prompt_version"])
                batch = f"{split}-{kind}-{uuid.uuid4().hex[:8]}"
                self._write(new.withColumn("batch", F.lit(batch)), "queues", "append")
                got = self.read("queues", split).where(F.col("batch") == batch).groupBy("source_file").count().collect()
            loads.update({r["source_file"]: r["count"] for r in got})
            count = sum(r["count"] for r in got)
            added += count
            if count < target:
                short[kind] = target - count
        if short and not partial:
            raise RuntimeError(f"no contexts left for {short} of {split}")
        return {"split": split, "added_rows": added, "unallocated_by_type": short, "source_counts": dict(sorted(loads.items()))}

    def _used(self) -> DataFrame | None:
        return self.read("queues").select(F.explode("context_ids").alias("paragraph_id")).distinct() if self.has("queues") else None

    def _context(self, prefix: str = "") -> Column:
        names = {"paragraph_id": "paragraph_id", "source_file": "source_file", "paragraph_index": "paragraph_index", "text": "cleaned_text"}
        return F.struct(*(F.col(f"{prefix}{c}").alias(n) for n, c in names.items()))

    def _singles(self, rows: DataFrame, kind: str, target: int, cap: int, loads: Mapping[str, int], preferred: Sequence[str]) -> DataFrame:
        chosen = selection.queue_singles(rows, kind, target, cap, self._used(), loads, preferred).select("paragraph_id")
        return rows.join(F.broadcast(chosen), "paragraph_id").select(F.array(self._context()).alias("contexts"))  # at most `target` ids

    def _pairs(self, rows: DataFrame, kind: str, target: int, cap: int, loads: Mapping[str, int], preferred: Sequence[str]) -> DataFrame:
        used = self._used()
        free = rows if used is None else rows.join(used, "paragraph_id", "left_anti")
        turns = selection.queue_pairs(free, kind, min(cap, target))
        load = F.lit(0)
        for name, n in loads.items():
            load = F.when(F.col("source_file") == name, F.lit(n)).otherwise(load)
        last = ~F.col("source_file").isin(*preferred) if preferred else F.lit(True)
        turns = turns.withColumn("load", load).where(F.col("load") + F.col("turn") < cap).orderBy("turn", last, "load", "source_file").limit(target)
        place = F.posexplode(F.array("first_id", "second_id")).alias("place", "paragraph_id")
        parts = turns.select(F.col("first_id").alias("pair"), place).join(rows, "paragraph_id")
        lists = parts.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("place", self._context().alias("c")))).alias("cs"))
        return lists.select(F.transform("cs", lambda x: x["c"]).alias("contexts"))

    # --- models and filters --------------------------------------------------------------------------------------------

    def generate(self, split: str, limit: int | None = None) -> int:
        """Records for the queue's rows that have none; returns how many."""
        queue = self.read("queues", split)
        gates.guard_single_value(queue, "config_hash", self.hash)
        bounds = (self.config["hard_filter"]["min_quote_chars"], self.config["hard_filter"]["max_quote_chars"])
        queue = queue.withColumn("prompt", prompts.generation_prompt(F.col("target_question_type"), F.col("source_text"), bounds))
        done = self.read("generations", split).select("candidate_id") if self.has("generations") else None
        todo = queue if done is None else consensus.pending(queue, done, "candidate_id")
        todo = todo if limit is None else todo.orderBy("candidate_id").limit(limit)
        return self._append(generation.run_generation(todo, None, self.generator, self.config["generation"].get("batch_size", 8)), split, "generations")

    def _append(self, records: DataFrame, split: str, stage: str) -> int:
        batch = uuid.uuid4().hex[:12]
        self._write(records.withColumns({"split": F.lit(split), "batch": F.lit(batch), "made_at": F.lit(self.now())}), stage, "append")
        return self.read(stage, split).where(F.col("batch") == batch).count()

    def hard_filter(self) -> dict:
        h = self.config["hard_filter"]
        rules = generation.HardRules(
            (h["min_question_chars"], h["max_question_chars"]), (h["min_answer_chars"], h["max_answer_chars"]), (h["min_quote_chars"], h["max_quote_chars"]),
            h["min_answer_source_overlap"], h["long_copy_min_tokens"],
        )
        made = self.read("generations").select("candidate_id", "raw_generation")
        rows = self.read("queues").drop("batch").join(made, "candidate_id")
        rows = generation.hard_filter(rows, rules)
        foreign = gates.reasons((~F.col("config_hash").eqNullSafe(F.lit(self.hash)), "config_hash_mismatch"))
        self._write(rows.withColumn("reasons", F.array_distinct(F.concat("reasons", foreign))), "hard_filtered")
        return self._report("hard_filtered")

    def _report(self, stage: str, column: str = "reasons") -> dict:
        rows = self.read(stage).groupBy("split").agg(F.count_if(F.size(column) == 0).alias("a"), F.count_if(F.size(column) > 0).alias("r")).collect()
        return {r["split"]: {"accepted": r["a"], "rejected": r["r"]} for r in rows}

    def _rules(self, prefix: str = "", context: bool = True) -> list[dedup.Rule]:
        h = self.config["hard_filter"]
        exact = [("exact_question", "question_key"), ("exact_answer", "answer_key"), *([("exact_context", "context_key")] if context else [])]
        near = [("near_question", "question_hash", h["question_simhash_distance"]), ("near_answer", "answer_hash", h["answer_simhash_distance"])]
        return [dedup.Rule(prefix + n, *rest) for n, *rest in exact + near]

    @staticmethod
    def _keyed(rows: DataFrame) -> DataFrame:
        hashes = {f"{c}_hash": T.simhash(F.col(c)) for c in ("question", "answer")}
        keys = {f"{c}_key": T.fingerprint(F.col(c)) for c in ("question", "answer")}
        return rows.withColumns(hashes).withColumns(keys | {"context_key": F.array_join("context_ids", ":")})

    def deduplicate(self) -> dict:
        """Within each split, best hard_quality_score first."""
        for n, split in enumerate(SPLITS):
            rows = self._keyed(gates.split_by(self.read("hard_filtered", split))[0].drop("reasons"))
            order = [-F.col("hard_quality_score"), T.descending(F.col("candidate_id"))]
            found = dedup.greedy_deduplicate(rows, "candidate_id", order, self._rules())
            found = found.withColumn("duplicate_cluster_id", dedup.cluster_ids(found, "candidate_id"))
            self._write(found, "deduplicated", "append" if n else "overwrite")
        return self._counts("deduplicated")

    def judge(self, split: str, name: str, limit: int | None = None) -> int:
        rows = self.read("deduplicated", split).where("duplicate_of is null").withColumn("prompt", prompts.judge_prompt(name))
        stage = f"judge_{name}"
        done = self.read(stage, split).select("candidate_id") if self.has(stage) else None
        todo = rows if done is None else consensus.pending(rows, done, "candidate_id")
        todo = todo if limit is None else todo.orderBy("candidate_id").limit(limit)
        return self._append(generation.run_judge(todo, None, self.judge_factory, self.config["judge"].get("parse_retries", 1)), split, stage)

    def agree(self) -> dict:
        rows = self.read("deduplicated").where("duplicate_of is null").drop("duplicate_reason", "duplicate_of", "duplicate_distance")
        sides = [self.read(f"judge_{p}").select("candidate_id", F.col("made_at").alias("line_no"), "judge_result") for p in PASSES]
        found = consensus.build_consensus(rows, *sides, "candidate_id", "line_no")
        self._write(found, "consensus")
        return self._report("consensus")

    # --- selection -----------------------------------------------------------------------------------------------------

    def global_deduplicate(self) -> tuple[DataFrame, DataFrame]:
        """Consensus rows that stay, and those that repeat one of a split before theirs in PRECEDENCE or a better one."""
        rows = gates.split_by(self.read("consensus"))[0]
        rank = F.array_position(F.array(*map(F.lit, PRECEDENCE)), F.col("split"))
        found = dedup.greedy_deduplicate(rows, "candidate_id", [rank, -F.col("quality_score"), T.descending(F.col("candidate_id"))], self._rules("global_", False))
        self._write(found.withColumn("duplicate_cluster_id", dedup.cluster_ids(found, "candidate_id", "global")), "global_deduplicated")
        found = self.read("global_deduplicated")
        return found.where("duplicate_of is null"), found.where("duplicate_of is not null")

    def select(self, allow_incomplete: bool = False, profile: Mapping | None = None) -> dict:
        """The final table; with a release profile its quotas, floors and excluded types hold instead, and no deficit is allowed."""
        pool, repeats = self.global_deduplicate()
        quotas = {s: dict(profile["final_quotas"][s]) if profile else self.quotas(s) for s in SPLITS}
        floors = (profile.get("source_floors", {}) if profile else self.config.get("final_source_floors", {}))
        excluded = list(profile["excluded_question_types"]) if profile else []
        if wrong := {s: sorted(set(excluded) & set(q)) for s, q in quotas.items() if set(excluded) & set(q)}:
            raise ValueError(f"excluded types have quotas: {wrong}")
        release = {"release_version": profile["release_version"], "release_profile_hash": audit.canonical_sha256(dict(profile))} if profile else {}
        result: dict = {"global_duplicate_rows": repeats.count()}
        for n, split in enumerate(SPLITS):
            rows = pool.where((F.col("split") == split) & ~F.col("question_type").isin(excluded) if excluded else F.col("split") == split)
            floor = int(floors.get(split, 0))
            chosen, deficits = selection.select_with_quotas(rows, quotas[split], self.config["final_source_caps"][split], floor, self.sources(split))
            loads = {r[0]: r[1] for r in chosen.groupBy("source_file").count().collect()}
            if failed := [s for s in self.sources(split) if loads.get(s, 0) < floor]:
                deficits["source_floor"] = len(failed)
            if deficits and (profile or not allow_incomplete):
                raise RuntimeError(f"{split} lacks {deficits}")
            version = self.config["sft_version" if split == "train" else "benchmark_version"]
            message = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
            final = rows.join(F.broadcast(chosen.select("candidate_id")), "candidate_id", "left_semi").withColumns(  # at most the quotas' sum
                {
                    "id": T.fingerprint(F.concat(F.lit(f"{self.config['sft_version']}:"), F.col("candidate_id"))),
                    "messages": F.array(message("user", "question"), message("assistant", "answer")),
                    "dataset_version": F.lit(version), "selected_at": F.lit(self.now()), **{k: F.lit(v) for k, v in release.items()},
                }
            )
            self._write(final, "final", "append" if n else "overwrite")
            types = {r[0]: r[1] for r in self.read("final", split).groupBy("question_type").count().collect()}
            result[split] = {"rows": sum(types.values()), "target": sum(quotas[split].values()), "deficits": deficits, "types": types, "sources": loads}
        return result

    def export(self, folder: str, profile: Mapping | None = None) -> dict:
        """Canonical JSON lines of each split in a folder of the driver, and the seal of the test split."""
        hashes = {}
        for split in SPLITS:
            path = f"{folder}/{split}.jsonl"
            sinks.write_canonical(self.read("final", split), path, "id")
            hashes[split] = sinks.sha256_file(path)
        rows = self.read("final", "test").count()
        complete = profile is not None or rows == sum(self.quotas("test").values())
        seal = {"sealed": complete, "benchmark_grade": "silver", "dataset_version": self.config["benchmark_version"], "rows": rows, "sha256": hashes["test"],
                "sealed_at": self.now(), "config_hash": self.hash}
        sinks.write_document(f"{folder}/test_seal.json", seal)
        return {"artifact_sha256": hashes, "test_seal": seal}

    def audit(self, profile: Mapping | None = None, exported: Mapping | None = None, folder: str | None = None) -> dict[str, bool]:
        """Named checks of the final table; raises if one fails."""
        rows = self.read("final")
        quotas = {s: dict(profile["final_quotas"][s]) if profile else self.quotas(s) for s in SPLITS}
        wanted = self.spark.createDataFrame([(s, k, n) for s, q in quotas.items() for k, n in q.items() if n], "split string, question_type string, n bigint")
        have = rows.groupBy("split", "question_type").agg(F.count("*").alias("n"))
        away = wanted.exceptAll(have).union(have.exceptAll(wanted)).count()
        splits = F.collect_set(F.when(F.col("split") == "challenge", "test").otherwise(F.col("split")))
        shared = rows.groupBy("source_file").agg(splits.alias("s")).where(F.size("s") > 1).count()
        fine = F.forall("evidence_spans", lambda s: s["end"] > s["start"]) & (F.size("contexts") > 0)
        unique = lambda c: F.count("*") == F.countDistinct(T.fingerprint(F.col(c)))
        graded = (F.col("split") == "train") | F.coalesce(F.col("benchmark_grade") == "silver", F.lit(False))
        found = audit.require(
            audit.checks(
                rows,
                {
                    "target_counts": F.count("*") == sum(n for q in quotas.values() for n in q.values()), "type_quotas": F.lit(away == 0),
                    "sources_disjoint": F.lit(shared == 0), "global_exact_questions_unique": unique("question"), "global_exact_answers_unique": unique("answer"),
                    "provenance_and_offsets": F.bool_and(fine), "config_hash": F.bool_and(F.col("config_hash") == self.hash),
                    "dual_judge_present": F.bool_and(F.col("rubric").isNotNull() & F.col("adversarial").isNotNull()), "silver_benchmark_labels": F.bool_and(graded),
                },
            )
        )
        if exported is not None and not (exported["test_seal"]["sealed"] and exported["test_seal"]["sha256"] == sinks.sha256_file(f"{folder}/test.jsonl")):
            raise ValueError("failed checks: test_sealed")
        return found

    # --- the whole -----------------------------------------------------------------------------------------------------

    def run(self, raw: DataFrame, expected: tuple[int, int, int] | None = None, smoke_limit: int | None = None, max_rounds: int = 20) -> dict:
        """Every stage, with refills until the quotas are met; raises when no context is left to fill them."""
        result: dict = {"clean": self.clean(raw), "split": self.split(expected)}
        for s in SPLITS:
            if not self._counts("queues").get(s):
                self.queue(s)
            result[f"generate_{s}"] = self.generate(s, smoke_limit)
        if smoke_limit is not None:
            return result
        for number in range(1, max_rounds + 1):
            self.hard_filter()
            self.deduplicate()
            for s in SPLITS:
                for name in PASSES:
                    self.judge(s, name)
            self.agree()
            chosen = self.select(allow_incomplete=True)
            result["selection"], result["rounds"] = chosen, number
            added, missing = 0, False
            for s in SPLITS:
                floor = int(self.config.get("final_source_floors", {}).get(s, 0))
                short = {x: floor - chosen[s]["sources"].get(x, 0) for x in self.sources(s) if chosen[s]["sources"].get(x, 0) < floor}
                lacks = {k: n for k, n in chosen[s]["deficits"].items() if k != "source_floor" and n > 0}
                if ask := selection.refill_requests(lacks, short, list(self.config["final_quotas"][s])):
                    missing = True
                    added += (more := self.queue(s, ask, sorted(short), partial=True)["added_rows"])
                    if more:
                        self.generate(s)
            if not missing:
                result["audit"] = self.audit()
                return result
            if not added:
                raise RuntimeError(f"no contexts left to fill {[(s, chosen[s]['deficits']) for s in SPLITS]}")
        raise RuntimeError(f"quotas not filled after {max_rounds} rounds")

    def status(self) -> DataFrame:
        """Rows of each stage by split."""
        stages = ("queues", "generations", "hard_filtered", "deduplicated", "judge_rubric", "judge_adversarial", "consensus", "global_deduplicated", "final")
        return audit.status_matrix({s: self.read(s).select("split") for s in stages if self.has(s)})
