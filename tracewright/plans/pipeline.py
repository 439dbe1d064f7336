"""The stages from lines to incidents, restartable from any of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..operators import baseline, features, graph, scoring, sessions, templates
from ..operators.models import ModelStore
from ..sources import logs, sinks
from . import views

ORDER = ["parsing", "features", "anomaly", "correlation", "scoring", "storage"]
OUTPUTS = {
    "parsing": ["sessionized_logs"], "features": ["features", "zscore_baseline_store", "feature_rolling_store"], "anomaly": ["anomaly"],
    "correlation": ["graph_scores", "sequences"], "scoring": ["scored_logs", "root_causes"], "storage": ["incidents", "summaries"],
}


@dataclass
class Pipeline:
    """Stages exchange parquet tables below ``folder``; a stage reads what earlier ones wrote."""

    spark: SparkSession
    folder: str
    year: int | None = None
    config: Config = DEFAULT
    done: list[str] = field(default_factory=list)
    warning: str | None = None
    summariser: Callable[[DataFrame], DataFrame] | None = None

    def read(self, name: str) -> DataFrame:
        return logs.read_table(self.spark, f"{self.folder}/{name}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        sinks.write_table(df, f"{self.folder}/{name}")
        return self.read(name)

    def parsing(self, source: DataFrame) -> None:
        rows = logs.number_lines(logs.normalize(source, year=self.year), keep=F.col("timestamp").isNotNull())
        mined = self.write(templates.mine_templates(rows, self.config), "_mined")
        found = self.write(templates.template_list(mined), "templates")
        sinks.write_csv(found, f"{self.folder}/templates.csv")
        self.warning = templates.template_warning(found.count())
        self.write(sessions.sessionized_logs(mined, self.config), "sessionized_logs")

    def features(self) -> None:
        rows = self.read("sessionized_logs")
        try:
            store = self.read("zscore_baseline_store")
        except FileNotFoundError:
            store = self.spark.createDataFrame([], baseline.STORE)
        scored, after = baseline.zscore_persistent(rows, store)
        out = self.write(features.build_features(rows, scored, config=self.config), "features")
        features.validate_features(out)
        sinks.upsert_table(self.spark, f"{self.folder}/zscore_baseline_store", after, ["host", "template_id"])
        self.write(baseline.last_sessions(out, self.config.rolling_sessions), "feature_rolling_store")

    def anomaly(self) -> None:
        """Score with the newest saved model; a retrained one serves the next run."""
        models = ModelStore(self.spark, f"{self.folder}/models", self.config)
        history = self.read("feature_rolling_store")
        self.write(models.detect(self.read("features"), history), "anomaly")

    def correlation(self) -> None:
        rows = self.read("sessionized_logs")
        self.write(graph.graph_scores(rows, config=self.config), "graph_scores")
        sinks.write_sequences(self.write(graph.sequences(rows, config=self.config), "sequences"), f"{self.folder}/sequences.json")
        nodes, links = graph.cached_graph(rows, f"{self.folder}/graph_cache", config=self.config)
        graph.graph_document(nodes, links, graph.node_scores(nodes, links, self.config)).write.mode("overwrite").text(f"{self.folder}/graph.json")

    def scoring(self) -> None:
        merged = scoring.importance(scoring.merge_scores(self.read("features"), self.read("anomaly"), self.read("graph_scores")), self.config)
        found = self.write(scoring.cluster_incidents(merged, self.config), "_incidents")
        causes = self.write(scoring.root_causes(found, self.config), "root_causes")
        self.write(scoring.scored_logs(found, causes), "scored_logs")

    def storage(self) -> None:
        rows = self.read("sessionized_logs").join(self.read("scored_logs"), "sequence_number")
        causes = self.read("root_causes")
        for name, table in (("logs", rows), ("features", self.read("features")), ("anomalies", self.read("anomaly")), ("scores", rows)):
            sinks.store(self.spark, f"{self.folder}/store", name, table)
        best = views.best_causes(views.incident_rollup(rows), causes)
        found = best.withColumnsRenamed({"correlation_id": "incident_id", "confidence_score": "root_cause_confidence"})
        sinks.store(self.spark, f"{self.folder}/store", "incidents", found.withColumns({"severity": F.col("label"), "status": F.lit("open")}))
        sinks.upsert_table(self.spark, f"{self.folder}/incidents", best, ["correlation_id"])
        context = views.summary_context(rows, causes)
        try:
            known = self.read("summaries")
        except FileNotFoundError:
            known = self.spark.createDataFrame([], "correlation_id string, summary_text string")
        new = views.summarize_missing(context, known, self.summariser)
        sinks.store(self.spark, f"{self.folder}/store", "summaries", new)
        sinks.upsert_table(self.spark, f"{self.folder}/summaries", new, ["correlation_id"])

    def run(self, source: DataFrame | None = None, from_step: str = "parsing", dry_run: bool = False) -> list[str]:
        """Run the stages from ``from_step`` on; returns their names.  A dry run only names them."""
        if from_step not in ORDER:
            raise ValueError(f"unknown step {from_step}; steps are {ORDER}")
        steps = ORDER[ORDER.index(from_step) :]
        for step in [] if dry_run else steps:
            stage: Callable = getattr(self, step)
            stage(source) if step == "parsing" else stage()
            self.done.append(step)
        return steps

    def summary(self) -> dict[str, int]:
        """Rows of every output there is."""
        out = {}
        for name in (n for names in OUTPUTS.values() for n in names):
            try:
                out[name] = self.read(name).count()
            except FileNotFoundError:
                pass
        return out
