"""Values fixed by the data contract. Everything here is data, not logic."""

# --- fixed values: aggregation levels -------------------------------------------------
LEVELS = ["1m", "15m", "1h", "1d"]
LEVEL_WIDTHS = {"1m": "1 minute", "15m": "15 minutes", "1h": "1 hour", "1d": "1 day"}
LEVEL_SECONDS = {"1m": 60, "15m": 900, "1h": 3600, "1d": 86400}
# one event per 5 seconds and machine
EXPECTED_EVENTS = {"1m": 12, "15m": 180, "1h": 720, "1d": 17280}
EXPECTED_EQUIPMENT = 13
EXPECTED_EVENTS_PER_DAY = 17280
# bounds, in seconds, of the histogram of arrival delays
LATENESS_EDGES = (0, 1, 5, 60, 300, 900, 3600)

# --- fixed values: electrical limits --------------------------------------------------
LINE_VOLTAGE_MIN = 360.0
WINDOW_POWER_FACTOR_MIN = 90.0
REPORT_POWER_FACTOR_MIN = 90
REPORT_VOLTAGE_IMBALANCE_MAX = 3
REPORT_CURRENT_IMBALANCE_MAX = 30
CARBON_KG_PER_KWH = 0.466

# --- fixed values: scoring ------------------------------------------------------------
# rule features in evaluation order, with the side that is abnormal
RULE_DIRECTIONS = {
    "avg_current_imbalance_rate": "high",
    "avg_voltage_imbalance_rate": "high",
    "rolling_15m_peak_kW": "high",
    "carbon_emission_kg": "high",
    "avg_power_factor": "low",
    "kepco_30m_pf": "low",
}
# level, rule weight, forest weight, reference only, 1st and 99th percentile of -decision
LEVEL_CONFIG = [
    ("1m", 0.55, 0.45, False, -0.09218557276219132, 4.929128242045109e-17),
    ("15m", 0.55, 0.45, False, -0.0999250532548054, 3.900242614971231e-18),
    ("1h", 0.55, 0.45, False, -0.10901689184507325, -2.825532505450895e-17),
    ("1d", 0.60, 0.40, True, -0.13810323043914724, -2.7159264420761886e-17),
]
DEFAULT_WEIGHTS = (0.55, 0.45)
DEFAULT_WEIGHTS_1D = (0.60, 0.40)
WATCH_FROM, WARNING_FROM, CRITICAL_FROM = 30, 50, 75
LOW_EVENT_SHARE = 0.2
LOW_COMPLETENESS = 0.8

BASE_FEATURES = [
    "estimated_kW", "rolling_15m_avg_kW", "rolling_15m_peak_kW", "carbon_emission_kg",
    "avg_voltage_imbalance_rate", "avg_current_imbalance_rate", "avg_power_factor",
    "kepco_10m_v_imb", "kepco_10m_c_imb", "kepco_30m_pf", "event_count",
    "completeness_ratio", "hour", "dayofweek", "is_weekend",
]
KNOWN_EQUIPMENT = [
    "1(PM-3)", "11(우측분전반1)", "12(4호기)", "13(3호기)", "14(2호기)", "15(예비건조기)",
    "16(호이스트)", "17(6호기)", "18(우측분전반2)", "2(L-1전등)", "3(분쇄기(2))",
    "4(분쇄기(1))", "5(좌측분전반)",
]
REQUIRED_SCORING_COLUMNS = [
    "equipment_id", "window_end_time", "aggregation_level",
    "avg_voltage_r", "avg_voltage_s", "avg_voltage_t",
    "avg_current_r", "avg_current_s", "avg_current_t",
    "avg_power_factor", "avg_voltage_imbalance_rate", "avg_current_imbalance_rate",
    "event_count", "rolling_15m_peak_kW", "carbon_emission_kg",
    "kepco_10m_v_imb", "kepco_10m_c_imb", "kepco_30m_pf",
    "hour", "dayofweek", "is_weekend",
]
OPTIONAL_SCORING_COLUMNS = ["completeness_ratio", "estimated_kW", "rolling_15m_avg_kW"]
PREDICTION_COLUMNS = [
    "equipment_id", "window_end_time", "aggregation_level", "rule_anomaly", "rule_score",
    "rule_reason", "triggered_features", "triggered_feature_values", "threshold_values",
    "threshold_direction", "iforest_anomaly", "iforest_score", "iforest_score_raw",
    "final_anomaly_score", "final_anomaly_level", "primary_anomaly_model",
    "model_vote_count", "strong_anomaly_candidate", "critical_candidate",
    "rule_contribution", "iforest_contribution", "final_reason", "recommended_action",
    "data_quality_issue_flag", "data_quality_reason", "created_at", "reference_only",
]
STORED_PREDICTION_COLUMNS = [
    "equipment_id", "window_end_time", "final_anomaly_score", "final_anomaly_level",
    "strong_anomaly_candidate", "critical_candidate", "final_reason", "recommended_action",
    "aggregation_level", "rule_anomaly", "rule_score", "rule_reason", "iforest_anomaly",
    "iforest_score", "primary_anomaly_model", "model_vote_count", "rule_contribution",
    "iforest_contribution", "data_quality_issue_flag", "data_quality_reason",
    "created_at", "reference_only",
]

# --- fixed values: texts --------------------------------------------------------------
ACTIONS = {
    "avg_current_imbalance_rate_high": "전류 불균형 및 부하 편차 점검",
    "avg_voltage_imbalance_rate_high": "전압 불평형 및 전원 품질 점검",
    "avg_power_factor_low": "역률 저하 및 무효전력 보상 상태 점검",
    "kepco_30m_pf_low": "누적 역률 저하 원인 점검",
    "rolling_15m_peak_kW_high": "피크 부하 및 설비 동시 가동 여부 점검",
    "carbon_emission_kg_high": "고부하 운전 및 에너지 사용량 점검",
}
ACTION_UNKNOWN = "이상 원인 세부 확인"
ACTION_FOREST_ONLY = "다변량 패턴 이상 여부 점검"
ACTION_ROUTINE = "정기 모니터링 유지"

# printf templates; arguments: equipment, window end, [features, forest score,] level
REASON_RULE = (
    "%s 설비가 %s 기준 %s 항목에서 기준을 벗어났고, "
    "IsolationForest 점수 %.1f로 %s 이상 후보로 분류되었습니다."
)
REASON_FOREST = (
    "%s 설비가 %s 기준 단일 Rule 기준 초과는 없으나, "
    "IsolationForest 기준 다변량 패턴이 정상 구간과 달라 %s 이상 후보로 분류되었습니다."
)
REASON_NORMAL = "%s 설비는 %s 기준 최종 이상 점수가 %s 범위로 분류되었습니다."

ALERT_TITLE = "[%s] 설비 이상 감지 - %s"

ISSUE_POWER_FACTOR = "역률 저하(%.2f%%)"
ISSUE_VOLTAGE = "전압 불균형(%.2f%%)"
ISSUE_CURRENT = "전류 불균형(%.2f%%)"

STATUS_FEW_MACHINES = (
    "집계 설비 수가 %d개로 예상 설비 수 %d개보다 적습니다. 데이터 누락 여부 확인이 필요합니다."
)
STATUS_INCOMPLETE = "수집 완전성이 %.2f%%입니다. 일부 시간대 데이터 누락 여부 확인이 필요합니다."
STATUS_NORMAL = "전체 설비에서 주요 전력 품질 이상 후보가 감지되지 않았습니다."
STATUS_SOME = "일부 설비에서 이상 후보가 감지되었습니다. 추이 확인이 필요합니다."
STATUS_MANY = "복수 설비에서 이상 후보가 감지되었습니다. 우선 점검 대상 확인이 필요합니다."

INSIGHT_FEW_MACHINES = (
    "집계 설비 수가 %d개로 예상 설비 수 %d개보다 적습니다. "
    "원천 데이터 누락 또는 집계 실패 여부를 확인해야 합니다."
)
INSIGHT_INCOMPLETE = (
    "수집 완전성이 %.2f%%로 낮습니다. 일부 시간대 또는 설비 데이터가 누락되었을 가능성이 있습니다."
)
INSIGHT_POWER_FACTOR = (
    "평균 역률 90%% 미만 설비가 %d개 감지되었습니다. 무효전력 증가 및 요금 리스크를 확인해야 합니다."
)
INSIGHT_VOLTAGE = (
    "전압 불균형률 3%% 이상 설비가 %d개 감지되었습니다. "
    "전압 품질 및 설비 부하 상태 점검이 필요합니다."
)
INSIGHT_CURRENT = (
    "전류 불균형률 30%% 이상 설비가 %d개 감지되었습니다. 상별 부하 편중 가능성이 있습니다."
)
INSIGHT_TOP = "우선 점검 대상은 %s입니다. 감지 항목: %s."
INSIGHT_NONE = "주요 전력 품질 지표와 데이터 수집 상태에서 특이사항은 감지되지 않았습니다."

REPORT_TITLE = "일일 전력 관제 리포트 - %s"
REPORT_SENT = "Daily report workflow sent successfully."
REPORT_WAITING = (
    "Daily summary is not complete. report_date=%s, actual_count=%d, expected_count=%d"
)

# --- fixed values: alert queue --------------------------------------------------------
DISPATCH_LIMIT = 20
RETRY_LIMIT = 3
ERROR_TEXT_LIMIT = 1000
SEVERITY_ORDER = ["critical", "warning", "recovery"]

# --- fixed values: injected demo anomaly ----------------------------------------------
INJECT_POWER, INJECT_CURRENT, INJECT_POWER_FACTOR = 1.6, 1.4, 0.75
INJECT_LABEL = "overload_low_power_factor"
