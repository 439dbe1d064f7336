"""Constants that define the engine's results, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    session_gap_s: int = 1800
    severity_weights: dict = field(default_factory=lambda: {"CRITICAL": 1.0, "ERROR": 0.7, "WARN": 0.4, "INFO": 0.1})
    default_weight: float = 0.1
    source_type: str = "switch"
    sim_threshold: float = 0.5
    max_children: int = 100
    baseline_sessions: int = 20
    ema_alpha: float = 0.3
    proximity_window_s: int = 30
    rolling_sessions: int = 50
    trees: int = 100
    subsample: int = 256
    seed: int = 42
    isolation_weight: float = 0.7
    zscore_weight: float = 0.3
    full_confidence_rows: int = 500
    fallback_threshold: float = 0.5
    dynamic_k: float = 2.0
    min_train_rows: int = 50
    retrain_sessions: int = 50
    retrain_every: int = 1000
    graph_window_s: int = 60
    graph_max_nodes: int = 500
    pagerank_alpha: float = 0.85
    betweenness_pivots: int = 50
    sequence_window_s: int = 30
    sequence_length: int = 3
    sequence_support: int = 5
    ml_weight: float = 0.65
    graph_weight: float = 0.35
    label_maxima: tuple = (0.2, 0.5, 0.75)
    dbscan_eps: float = 0.3
    dbscan_min: int = 5
    root_causes: int = 3


DEFAULT = Config()

#: Daemon names with a canonical subsystem.
SERVICE_ALIASES = {
    "eventmgr": "SYSTEM", "hpe-routing": "ROUTING", "kernel": "SYSTEM", "sshd": "SYSTEM", "cron": "SYSTEM",
    "sudo": "SYSTEM", "snmpd": "SNMP", "lldpd": "LLDP", "cfgd": "CONFIG",
}

#: Severities of the three low bits of a PRI code.
PRI_SEVERITY = ("CRITICAL", "CRITICAL", "CRITICAL", "ERROR", "WARN", "INFO", "INFO", "INFO")

#: Words that name a severity.
SEVERITY_WORDS = {
    "CRITICAL": "CRITICAL", "CRIT": "CRITICAL", "ERROR": "ERROR", "ERR": "ERROR", "WARNING": "WARN",
    "WARN": "WARN", "NOTICE": "INFO", "DEBUG": "INFO", "INFO": "INFO",
}

#: Message patterns that set the severity, first match first.
SEVERITY_PATTERNS = (
    (r"changed state from \S+ to DOWN", "CRITICAL"),
    (r"adjacency.*lost|adjacency.*down", "CRITICAL"),
    (r"port scan detected", "CRITICAL"),
    (r"temperature.*threshold|thermal.*exceed", "CRITICAL"),
    (r"link.*flap|flap.*detect", "CRITICAL"),
    (r"changed state to down", "ERROR"),
    (r"authentication failure", "ERROR"),
    (r"ACL error", "ERROR"),
    (r"session.*reset|reset.*session", "ERROR"),
    (r"disk.*latency|write.*latency", "ERROR"),
    (r"login failed|login failure", "ERROR"),
    (r"Drop DHCP|untrusted port", "WARN"),
    (r"MAC .{5,30} blocked", "WARN"),
    (r"cpu.*utilization.*exceed|cpu.*threshold", "WARN"),
    (r"memory.*usage|mem.*threshold", "WARN"),
    (r"packet drop.*high|drop rate.*high", "WARN"),
    (r"changed state to up", "INFO"),
    (r"adjacency.*established|session established", "INFO"),
    (r"configuration saved|config.*saved", "INFO"),
    (r"login successful|login success", "INFO"),
    (r"binding added|vlan.*added|vlan.*removed", "INFO"),
)

#: Tokens that vary (numbers, ports, addresses, sizes, shares, times, MACs).
VARIABLE_TOKEN = (
    r"^(\d+|\d+\.\d+|\d+/\d+(/\d+)*|\d{1,3}(\.\d{1,3}){3}(/\d+)?|\d+[kmgKMG]?[bB]?|\d+%|\d+ms|[0-9a-fA-F]{2}(:[0-9a-fA-F]{2}){5})$"
)

#: Templates of counter anomalies, and words that hint at more of them.
COUNTER_PATTERNS = (r"INTERFACE_.*THRESHOLD", r"INTERFACE_.*ERROR.*EXCEED", r"INTERFACE_.*DROP.*EXCEED")
COUNTER_HINTS = ("THRESHOLD", "ERROR", "DROP", "EXCEED")
