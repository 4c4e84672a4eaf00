"""The catalogue's queries as SQL for an independent engine (DuckDB).

Used to check results only. The statements are written straight from each
operator's definition and avoid the library's methods: intervals are merged by
counting open ones along time, previous rows come from self-joins, latest rows
from ranking.
"""

from __future__ import annotations

import re

from stayframe.operators.lookback import labels_of
from stayframe.plans import study
from stayframe.plans.concepts import COMORBIDITIES, SEPSIS
from stayframe.plans.views import output_name
from stayframe.sources import mapped


def days(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 86400000000.0)"


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) AS {name}"


def flag(predicate: str) -> str:
    return f"CASE WHEN {predicate} THEN 1 ELSE 0 END"


def ids(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


def quoted(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def merged(source: str) -> str:
    """Union of closed intervals: opens and closes counted along time."""
    return f"""
  SELECT o.icustay_id, o.t AS starttime, c.t AS endtime FROM
   (SELECT *, row_number() OVER (PARTITION BY icustay_id ORDER BY t) AS n FROM
     (SELECT *, sum(d) OVER (PARTITION BY icustay_id ORDER BY t, d DESC ROWS UNBOUNDED PRECEDING) AS depth
      FROM (SELECT icustay_id, starttime AS t, 1 AS d FROM {source} UNION ALL
            SELECT icustay_id, endtime, -1 FROM {source}))
    WHERE d = 1 AND depth = 1) o
  JOIN
   (SELECT *, row_number() OVER (PARTITION BY icustay_id ORDER BY t) AS n FROM
     (SELECT *, sum(d) OVER (PARTITION BY icustay_id ORDER BY t, d DESC ROWS UNBOUNDED PRECEDING) AS depth
      FROM (SELECT icustay_id, starttime AS t, 1 AS d FROM {source} UNION ALL
            SELECT icustay_id, endtime, -1 FROM {source}))
    WHERE d = -1 AND depth = 0) c
  USING (icustay_id, n)"""


def episodes(source: str) -> str:
    """Episodes of a dose table with one row per stay, item and time."""
    return f"""
  SELECT icustay_id, itemid, starttime, endtime FROM (
    SELECT icustay_id, itemid, nr, min(CASE WHEN rate IS NOT NULL THEN charttime END) AS starttime,
      min(CASE WHEN stopped = 1 OR rate = 0 OR nxt IS NULL THEN charttime END) AS endtime,
      min(charttime) AS earliest, max(rate) AS top
    FROM (
      SELECT *, sum(mark) OVER (PARTITION BY icustay_id, itemid ORDER BY charttime) AS nr FROM (
        SELECT *, CASE WHEN rate > 0 AND before IS NULL THEN 1
                       WHEN coalesce(rate, before) = 0 AND before = 0 THEN 0
                       WHEN before = 0 OR was_stopped = 1 THEN 1 END AS mark
        FROM (
          SELECT *, lag(stopped) OVER w AS was_stopped, lead(charttime) OVER w AS nxt,
            last_value(rate IGNORE NULLS) OVER (PARTITION BY icustay_id, itemid ORDER BY charttime
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM {source} WINDOW w AS (PARTITION BY icustay_id, itemid ORDER BY charttime))))
    WHERE nr >= 1 GROUP BY icustay_id, itemid, nr)
  WHERE earliest <> endtime AND top > 0"""


def drug(prefix: str, points: str, intervals: str, early: tuple, across: bool = False) -> dict[str, str]:
    """CTEs of one drug group's features."""
    p = prefix
    parts = {
        f"{p}_dose": f"SELECT * FROM dose WHERE itemid IN {points}",
        f"{p}_cv": episodes(f"{p}_dose"),
        f"{p}_mv": f"""SELECT icustay_id, min(starttime) AS starttime, max(endtime) AS endtime
          FROM inputevents_mv WHERE itemid IN {intervals} AND statusdescription <> 'Rewritten'
          GROUP BY icustay_id, linkorderid""",
    }
    if across:
        parts[f"{p}_both"] = f"""SELECT icustay_id, starttime, endtime FROM {p}_cv UNION ALL
          SELECT icustay_id, starttime, endtime FROM {p}_mv"""
        parts[f"{p}_all"] = merged(f"{p}_both")
    else:
        parts[f"{p}_cvm"] = merged(f"{p}_cv")
        parts[f"{p}_mvm"] = merged(f"{p}_mv")
        parts[f"{p}_all"] = f"""
          SELECT icustay_id, row_number() OVER (PARTITION BY icustay_id ORDER BY starttime) AS number,
            starttime, endtime FROM {p}_cvm UNION
          SELECT icustay_id, row_number() OVER (PARTITION BY icustay_id ORDER BY starttime),
            starttime, endtime FROM {p}_mvm"""
    name = {"vaso": "vaso", "vasox": "vaso", "anes": "anes"}[p]
    marks = "".join(
        f", {flag(f'start_day <= {h}/24.0')} AS {name}_1st_{h}hr_flg" for h in early)
    parts[f"v_{p}"] = f"""
      SELECT subject_id, hadm_id, icustay_id, {flag('start_day IS NOT NULL')} AS {name}_flg,
        start_day AS {name}_start_day, free_day AS {name}_free_day, total AS {name}_day,
        {days('intime', 'outtime')} - total AS {name}_off_day{marks},
        CASE WHEN initial_aline_flg = 0 AND aline_flg = 1 AND start_day <= aline_time_day THEN 1
             WHEN initial_aline_flg = 0 AND aline_flg = 1 AND start_day > aline_time_day THEN 0
             WHEN initial_aline_flg = 0 AND aline_flg = 0 AND start_day <= 0 THEN 1
             WHEN initial_aline_flg = 0 AND aline_flg = 0 AND start_day > 0 THEN 0 END AS {name}_b4_aline
      FROM (SELECT c.*, {days('intime', 'e.a')} AS start_day, {days('e.b', 'outtime')} AS free_day,
              e.us / 86400000000.0 AS total
            FROM cohort c LEFT JOIN (
              SELECT icustay_id, min(starttime) AS a, max(endtime) AS b,
                sum(epoch_us(endtime) - epoch_us(starttime)) AS us FROM {p}_all GROUP BY icustay_id) e
            USING (icustay_id))"""
    return parts


def code_test(rule, code: str = "icd9_code", trim: bool = False) -> str:
    tests = [f"starts_with({code}, '{p}')" for p in rule.prefixes]
    if rule.exact:
        exact = [c.strip() for c in rule.exact] if trim else rule.exact
        tests.append(f"{code} IN {quoted(exact)}")
    tests += [f"({code} >= '{a}' AND {code} <= '{b}')" for a, b in rule.ranges]
    return " OR ".join(tests)


def icd_view(trim: bool) -> str:
    code = "trim(icd9_code)" if trim else "icd9_code"
    flags = ", ".join(
        f"coalesce(max({flag(code_test(rule, code, trim))}), 0) AS {name}"
        for name, rule in COMORBIDITIES.items())
    return f"SELECT c.hadm_id, {flags} FROM cohort c LEFT JOIN diagnoses_icd d USING (hadm_id) GROUP BY c.hadm_id"


def lab_case(items) -> str:
    return "CASE itemid " + " ".join(f"WHEN {i} THEN '{x.label}'" for i, x in items.items()) + " END"


def regex(pattern: str, column: str = "text") -> str:
    p = "(?s)" + pattern
    return f"CASE WHEN regexp_matches({column}, '{p}') THEN regexp_extract({column}, '{p}', 1) END"


def number(pattern: str) -> str:
    found = regex(pattern)
    return f"CASE WHEN ({found}) NOT LIKE '%*%' THEN try_cast({found} AS DOUBLE) END"


NOTE_NUMBERS = {
    "height_first": r"Height: \(in\) (.*?)\n", "weight_first": r"Weight \(lb\): (.*?)\n",
    "bsa_first": r"BSA \(m2\): (.*?) m2\n", "bpsys": r"BP \(mm Hg\): ([0-9]+)/[0-9]+?\n",
    "bpdias": r"BP \(mm Hg\): [0-9]+/([0-9]+?)\n", "hr": r"HR \(bpm\): ([0-9]+?)\n",
}
NOTE_TEXTS = {
    "indication": r"Indication: (.*?)\n", "bp": r"BP \(mm Hg\): (.*?)\n", "status": r"Status: (.*?)\n",
    "test": r"Test: (.*?)\n", "doppler": r"Doppler: (.*?)\n", "contrast": r"Contrast: (.*?)\n",
    "technicalquality": r"Technical Quality: (.*?)\n",
}
CLOCK = regex(r"Date/Time: [\[\]0-9*-]+ at ([0-9:]+)")
NOTE_FIELDS = ", ".join(
    [f"{number(p)} AS {n}" for n, p in NOTE_NUMBERS.items()]
    + [f"{regex(p)} AS {n}" for n, p in NOTE_TEXTS.items()])
CHARTTIME = f"strptime(strftime(chartdate, '%d-%m-%Y') || ({CLOCK}), '%d-%m-%Y%H:%M')"
HALF_UP = "CAST(round(CAST(CAST({} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"

PANEL = labels_of(mapped.PANEL_ITEMS)
LAST_ROW = "QUALIFY row_number() OVER (PARTITION BY {key}, label ORDER BY charttime DESC, event_id DESC) = 1"


def window(table: str, hours: int, extra: str = "") -> str:
    return f"""SELECT e.*, c.icustay_id AS stay, c.hadm_id AS adm FROM {table} e JOIN cohort c
      ON e.subject_id = c.subject_id AND e.charttime <= c.vent_starttime
      AND e.charttime >= c.vent_starttime - INTERVAL {hours} HOUR {extra}"""


CTES: dict[str, str] = {
    "ev": """SELECT event_id, ts, user_id AS subject_id, user_id * 10 + (day(ts) - 1) // 10 AS icustay_id,
      event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events""",
    "icustays": """SELECT subject_id, icustay_id AS hadm_id, icustay_id, min(ts) AS intime,
      max(ts) AS outtime FROM ev GROUP BY subject_id, icustay_id""",
    "admissions": """SELECT hadm_id, subject_id, intime - INTERVAL 6 HOUR AS admittime,
      outtime + INTERVAL 12 HOUR AS dischtime,
      CASE WHEN icustay_id % 9 = 0 THEN outtime - INTERVAL 1 HOUR
           WHEN icustay_id % 9 = 4 THEN outtime + INTERVAL 6 HOUR END AS deathtime FROM icustays""",
    "patients": """SELECT DISTINCT subject_id, CASE WHEN subject_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
      TIMESTAMP '2024-01-01 00:00:00' - to_years(CAST(10 + subject_id % 70 AS INT)) AS dob,
      CASE WHEN subject_id % 5 = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
        + to_days(CAST(subject_id % 60 AS INT)) END AS dod FROM ev""",
    "services": """SELECT icustay_id AS hadm_id, event_id, ts - INTERVAL 2 DAY AS transfertime,
      CASE k % 8 WHEN 0 THEN 'CSURG' WHEN 1 THEN 'CMED' WHEN 2 THEN 'SURG' WHEN 3 THEN 'ORTHO'
        WHEN 4 THEN 'NB' WHEN 5 THEN 'TRAUM' ELSE 'MED' END AS curr_service
      FROM ev WHERE event_type = 'signup'""",
    "ventdurations": """SELECT icustay_id, event_id, ts AS starttime, ts + to_minutes(k) AS endtime
      FROM ev WHERE event_type = 'purchase'""",
    "chart0": """SELECT event_id, subject_id, icustay_id, ts AS charttime, k % 20 AS itemid,
      CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS valuenum,
      CASE k % 6 WHEN 0 THEN 'Full Code' WHEN 1 THEN 'Comfort Measures' WHEN 2 THEN 'Do Not Resuscitate'
        WHEN 3 THEN 'Other/Remarks' WHEN 4 THEN 'CPR Not Indicated' ELSE 'unmapped' END AS value
      FROM ev WHERE event_type IN ('click', 'view')""",
    "gcsevents": """SELECT event_id, subject_id, icustay_id, ts AS charttime, 200 + k % 3 AS itemid,
      CAST((k // 3) % 6 AS DOUBLE) AS valuenum FROM ev WHERE event_type IN ('click', 'view')""",
    "lab0": """SELECT event_id, subject_id, icustay_id AS hadm_id, ts AS charttime, k % 24 AS itemid,
      value AS valuenum, CASE WHEN k % 3 = 0 THEN 'abnormal' END AS flag
      FROM ev WHERE event_type IN ('error', 'view')""",
    "gasevents": """SELECT event_id, subject_id,
      date_trunc('day', ts)::TIMESTAMP + to_hours((hour(ts) // 12) * 12) AS charttime,
      100 + k % 3 AS itemid, value * 2 AS valuenum,
      CASE WHEN k % 5 = 0 THEN 'VEN' ELSE 'ART' END AS value
      FROM ev WHERE event_type IN ('error', 'view')""",
    "outputevents": """SELECT event_id, subject_id, icustay_id, ts AS charttime, k % 5 AS itemid, value
      FROM ev WHERE event_type IN ('error', 'signup')""",
    "inputevents_cv": """SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE icustay_id END AS icustay_id,
      ts AS charttime, k % 2 AS itemid,
      CASE WHEN k % 11 = 0 THEN 'Stopped' WHEN k % 13 = 0 THEN 'D/C''d' END AS stopped,
      CASE WHEN k % 5 = 0 THEN NULL WHEN k % 4 = 0 THEN 0.0 ELSE value END AS rate, value AS amount
      FROM ev WHERE event_type IN ('click', 'view')""",
    "inputevents_mv": """SELECT event_id, icustay_id, icustay_id * 10 + k % 4 AS linkorderid, k % 6 AS itemid,
      ts AS starttime, ts + to_minutes(30 * (k + 1)) AS endtime,
      CASE WHEN k % 7 = 0 THEN NULL ELSE value END AS rate, value AS amount,
      CASE WHEN k % 10 = 0 THEN 'Rewritten' WHEN k % 17 = 0 THEN NULL
        ELSE 'FinishedRunning' END AS statusdescription
      FROM ev WHERE event_type IN ('signup', 'purchase')""",
    "diagnoses_icd": """SELECT icustay_id AS hadm_id,
      CASE k % 12 WHEN 0 THEN '42731' WHEN 1 THEN '5185 ' WHEN 2 THEN '4280 ' WHEN 3 THEN '4280'
        WHEN 4 THEN '486' WHEN 5 THEN '0389' WHEN 6 THEN '99592' WHEN 7 THEN '2390' WHEN 8 THEN '1970'
        WHEN 9 THEN '5849' WHEN 10 THEN '41401' ELSE 'V5861' END AS icd9_code
      FROM ev WHERE event_type = 'error'""",
    "procedures_icd": """SELECT icustay_id AS hadm_id, CASE WHEN k % 3 = 0 THEN '9671' ELSE '3893' END AS icd9_code
      FROM ev WHERE event_type = 'purchase'""",
    "noteevents": """SELECT event_id AS row_id, icustay_id AS hadm_id,
      CASE WHEN k % 4 = 0 THEN 'Radiology' ELSE 'Echo' END AS category,
      date_trunc('day', ts)::TIMESTAMP AS chartdate,
      concat('Indication: case ', k, chr(10),
        CASE WHEN k % 7 = 0 THEN '' ELSE concat('Height: (in) ',
          CASE WHEN k % 5 = 0 THEN '[** num **]' ELSE CAST(55 + k % 25 AS VARCHAR) END, chr(10)) END,
        'Weight (lb): ', 100 + k, chr(10), 'BP (mm Hg): ', 90 + k, '/', 50 + k % 40, chr(10),
        'HR (bpm): ', 60 + k % 50, chr(10),
        CASE WHEN k % 9 = 0 THEN '' ELSE concat('Date/Time: [**2024-1-1**] at ',
          strftime(ts, '%H:%M'), chr(10)) END,
        'Status: Inpatient', chr(10)) AS text
      FROM ev WHERE event_type = 'signup'""",
    # Cohort
    "base": """SELECT i.*, a.admittime, a.dischtime, a.deathtime, p.gender, p.dob, p.dod
      FROM icustays i JOIN admissions a USING (hadm_id) JOIN patients p ON p.subject_id = i.subject_id
      WHERE i.intime > p.dob + INTERVAL 16 YEAR""",
    "placed": """SELECT icustay_id, min(charttime) AS starttime_aline FROM chart0
      WHERE itemid IN (0, 1, 2) AND valuenum IS NOT NULL GROUP BY icustay_id""",
    "vent": """SELECT icustay_id, sum(epoch_us(endtime) - epoch_us(starttime)) / 86400000000.0 AS vent_day,
      min(starttime) AS vent_starttime, max(endtime) AS vent_endtime
      FROM ventdurations GROUP BY icustay_id""",
    "served": """SELECT i.icustay_id, s.curr_service, s.transfertime FROM icustays i JOIN services s
      ON s.hadm_id = i.hadm_id AND s.transfertime < i.intime + INTERVAL 2 HOUR
      QUALIFY row_number() OVER (PARTITION BY i.icustay_id ORDER BY s.transfertime DESC, s.event_id DESC) = 1""",
    "flagged": f"""SELECT b.subject_id, b.hadm_id, b.icustay_id, intime, lower(dayname(intime)) AS day_icu_intime,
      CAST(dayofweek(intime) AS INT) AS day_icu_intime_num, CAST(hour(intime) AS INT) AS hour_icu_intime,
      outtime, row_number() OVER (PARTITION BY b.subject_id ORDER BY admittime, intime, b.icustay_id) AS stay_num,
      {days('dob', 'intime')} / 365.242 AS age, gender, {flag("gender = 'M'")} AS gender_num,
      starttime_aline, {flag('starttime_aline IS NOT NULL')} AS aline_flg,
      {days('intime', 'starttime_aline')} AS aline_time_day,
      {flag("starttime_aline <= intime + INTERVAL 1 HOUR")} AS initial_aline_flg,
      {flag('v.icustay_id IS NOT NULL')} AS vent_flg,
      {flag("vent_starttime < intime + INTERVAL 12 HOUR")} AS vent_1st_12hr,
      {flag("vent_starttime < intime + INTERVAL 24 HOUR")} AS vent_1st_24hr,
      CASE WHEN starttime_aline IS NULL THEN {flag("vent_starttime <= intime + INTERVAL 2 HOUR")}
           WHEN starttime_aline > intime + INTERVAL 1 HOUR AND vent_starttime IS NOT NULL
             THEN {flag('vent_starttime <= starttime_aline')} END AS vent_b4_aline,
      vent_day, {days('vent_endtime', 'outtime')} AS vent_free_day,
      {days('intime', 'outtime')} - vent_day AS vent_off_day, vent_starttime, vent_endtime,
      {days('intime', 'outtime')} AS icu_los_day, {days('admittime', 'dischtime')} AS hospital_los_day,
      CAST(dayofweek(intime) AS INT) AS intime_dayofweek, CAST(hour(intime) AS INT) AS intime_hour,
      curr_service AS service_unit,
      CASE WHEN curr_service LIKE '%SURG' OR curr_service LIKE '%ORTHO%' THEN 1
           WHEN curr_service = 'CMED' THEN 2 ELSE 0 END AS service_num,
      {flag('deathtime IS NOT NULL')} AS hosp_exp_flg, {flag('deathtime <= outtime')} AS icu_exp_flg,
      {flag("dod <= intime + INTERVAL 28 DAY")} AS day_28_flg,
      {days('admittime', 'dod')} AS mort_day, coalesce({days('admittime', 'dod')}, 150.0) AS mort_day_censored,
      {flag('dod IS NULL')} AS censor_flg
      FROM base b LEFT JOIN placed USING (icustay_id) LEFT JOIN vent v USING (icustay_id)
      LEFT JOIN served USING (icustay_id)""",
    "cohort": """SELECT * FROM flagged WHERE stay_num = 1 AND icu_los_day > 1 AND initial_aline_flg = 0
      AND vent_starttime < intime + INTERVAL 48 HOUR
      AND service_unit NOT IN ('CSURG', 'VSURG', 'TSURG', 'NB', 'NBB')""",
    # Labs and vitals
    "lab_day": f"SELECT *, {lab_case(mapped.LAB_ITEMS)} AS label FROM ({window('lab0', 24)})"
               f" WHERE itemid IN {ids(mapped.LAB_ITEMS)} {LAST_ROW.format(key='stay')}",
    "v_labs": "SELECT c.subject_id, c.hadm_id, " + ", ".join(
        f"max(CASE WHEN label = '{n}' THEN valuenum END) AS {output_name(n)}_first"
        for n in labels_of(mapped.LAB_ITEMS))
        + " FROM cohort c LEFT JOIN lab_day l ON l.adm = c.hadm_id GROUP BY c.subject_id, c.hadm_id",
    "vital_day": f"""SELECT *, lower({lab_case(mapped.VITAL_ITEMS)}) AS label,
        CASE WHEN itemid IN (6, 14) THEN (valuenum - 32) / 1.8 ELSE valuenum END AS reading
      FROM ({window('chart0', 24)}) WHERE itemid BETWEEN 3 AND 18 {LAST_ROW.format(key='stay')}""",
    "v_vitals": "SELECT c.subject_id, c.hadm_id, " + ", ".join(
        f"max(CASE WHEN label = '{n}' THEN reading END) AS {n}"
        for n in ("map", "temperature", "heartrate", "cvp", "spo2"))
        + " FROM cohort c LEFT JOIN vital_day v ON v.adm = c.hadm_id GROUP BY c.subject_id, c.hadm_id",
    "panel_week": f"SELECT *, {lab_case(mapped.PANEL_ITEMS)} AS label FROM ({window('lab0', 168)})",
    "panel_last": f"SELECT * FROM panel_week {LAST_ROW.format(key='adm')}",
    "panel_wide": "SELECT adm, " + ", ".join(
        f"max(CASE WHEN label = '{n}' THEN valuenum END) AS {output_name(n)}_first, "
        f"max({flag(f'''label = '{n}' AND flag = 'abnormal' ''')}) AS {output_name(n)}_abnormal_flg"
        for n in PANEL) + " FROM panel_last GROUP BY adm",
    "crit": """SELECT adm, min(valuenum) AS hct_lowest, max(valuenum) AS hct_highest,
      quantile_cont(valuenum, 0.5) AS hct_med FROM panel_week WHERE label = 'HEMATOCRIT' GROUP BY adm""",
    "v_panel": f"""SELECT c.subject_id, c.hadm_id, hct_med, hct_lowest, hct_highest,
      CASE WHEN hct_med BETWEEN CASE gender_num WHEN 1 THEN 44.7 ELSE 36.1 END
                            AND CASE gender_num WHEN 1 THEN 50.3 ELSE 44.3 END THEN 0 ELSE 1 END AS hct_abnormal_flg,
      w.* EXCLUDE (adm) FROM cohort c LEFT JOIN panel_wide w ON w.adm = c.hadm_id
      LEFT JOIN crit t ON t.adm = c.hadm_id""",
    # Codes
    "v_icd": icd_view(False),
    "v_icd_trimmed": icd_view(True),
    "v_sepsis": f"""SELECT *, {flag('explicit_sepsis = 1 OR (infection = 1 AND organ_dysfunction + mech_vent > 0)')} AS angus
      FROM (SELECT c.subject_id, c.hadm_id, c.icustay_id,
        {flag(f"EXISTS (SELECT 1 FROM diagnoses_icd d WHERE d.hadm_id = c.hadm_id AND ({code_test(SEPSIS.infection)}))")} AS infection,
        {flag(f"EXISTS (SELECT 1 FROM diagnoses_icd d WHERE d.hadm_id = c.hadm_id AND ({code_test(SEPSIS.explicit_sepsis)}))")} AS explicit_sepsis,
        {flag(f"EXISTS (SELECT 1 FROM diagnoses_icd d WHERE d.hadm_id = c.hadm_id AND ({code_test(SEPSIS.organ_dysfunction)}))")} AS organ_dysfunction,
        {flag(f"EXISTS (SELECT 1 FROM procedures_icd d WHERE d.hadm_id = c.hadm_id AND ({code_test(SEPSIS.mech_vent)}))")} AS mech_vent
      FROM cohort c JOIN admissions a USING (hadm_id))""",
    "v_vaso_flg": f"""SELECT subject_id, hadm_id, icustay_id,
      {flag('''EXISTS (SELECT 1 FROM inputevents_cv e WHERE e.icustay_id = c.icustay_id AND itemid = 7 AND rate > 0)
        OR EXISTS (SELECT 1 FROM inputevents_mv e WHERE e.icustay_id = c.icustay_id AND itemid = 5 AND rate > 0
                   AND statusdescription <> 'Rewritten')''')} AS vaso_flg FROM cohort c""",
    # Code status
    "status": """SELECT icustay_id, charttime, event_id, CASE value WHEN 'Full Code' THEN 'FullCode'
      WHEN 'Comfort Measures' THEN 'CMO' WHEN 'CPR Not Indicated' THEN 'DNCPR'
      WHEN 'Do Not Resuscitate' THEN 'DNR' END AS code,
      row_number() OVER (PARTITION BY icustay_id ORDER BY charttime, event_id) AS up,
      row_number() OVER (PARTITION BY icustay_id ORDER BY charttime DESC, event_id DESC) AS down
      FROM chart0 WHERE itemid IN (4, 9, 14, 19) AND value <> 'Other/Remarks'""",
    "status_wide": """SELECT icustay_id, max(CASE WHEN up = 1 THEN code END) AS firstcodestatus,
      max(CASE WHEN down = 1 THEN code END) AS lastcodestatus, """ + ", ".join(
        f"max({flag(f'''code = '{c}' ''')}) AS {c.lower()}" for c in ("DNR", "CMO", "DNCPR", "DNI", "FullCode"))
        + " FROM status GROUP BY icustay_id",
    "v_codestatus": f"""SELECT c.subject_id, c.hadm_id, c.icustay_id, s.* EXCLUDE (icustay_id),
      {flag("firstcodestatus = 'DNR'")} AS dnr_adm_flg,
      {flag("firstcodestatus <> 'DNR' AND dnr = 1")} AS dnr_switch_flg,
      {flag("firstcodestatus <> 'CMO' AND cmo = 1")} AS cmo_switch_flg,
      {flag("(firstcodestatus <> 'DNR' AND dnr = 1) OR (firstcodestatus <> 'CMO' AND cmo = 1)")} AS dnr_cmo_switch_flg
      FROM cohort c LEFT JOIN status_wide s USING (icustay_id)""",
    # Doses
    "dose": f"""SELECT icustay_id, itemid, charttime, max({flag("stopped IN ('Stopped', 'D/C''d')")}) AS stopped,
      max(rate) AS rate, max(amount) AS amount FROM inputevents_cv WHERE icustay_id IS NOT NULL
      GROUP BY icustay_id, itemid, charttime""",
    "cv_episodes": episodes("dose"),
    "orders": """SELECT icustay_id, linkorderid, min(starttime) AS starttime, max(endtime) AS endtime
      FROM inputevents_mv WHERE statusdescription <> 'Rewritten' GROUP BY icustay_id, linkorderid""",
    "cv_merged": merged("cv_episodes"),
    "mv_merged": merged("orders"),
    **drug("vaso", "(0, 1)", "(0, 1, 2)", (3, 6, 12)),
    **drug("vasox", "(0, 1)", "(0, 1, 2)", (3, 6, 12), across=True),
    **drug("anes", "(1)", "(3, 4)", ()),
    "cell_points": """SELECT c.icustay_id,
        sum(amount) FILTER (itemid = 0) AS rbc, sum(amount) FILTER (itemid = 1) AS rbc_or,
        sum(amount) FILTER (itemid = 0 AND charttime < intime + INTERVAL 1 DAY) AS rbc_day1,
        sum(amount) FILTER (itemid = 1 AND charttime < intime + INTERVAL 1 DAY) AS rbc_or_day1
      FROM inputevents_cv e JOIN icustays c USING (icustay_id) GROUP BY c.icustay_id""",
    "cell_parts": f"""SELECT c.icustay_id, itemid, amount, starttime <= intime + INTERVAL 1 DAY AS early,
        CASE WHEN endtime <= intime + INTERVAL 1 DAY THEN amount
             ELSE {days('starttime', '(intime + INTERVAL 1 DAY)')} / {days('starttime', 'endtime')} * amount END AS part
      FROM inputevents_mv e JOIN icustays c USING (icustay_id) WHERE statusdescription <> 'Rewritten'""",
    "cell_intervals": """SELECT icustay_id,
        sum(amount) FILTER (itemid IN (0, 1) AND early) AS rbc, sum(amount) FILTER (itemid IN (2, 3) AND early) AS rbc_or,
        sum(part) FILTER (itemid IN (0, 1)) AS rbc_day1, sum(part) FILTER (itemid IN (2, 3)) AS rbc_or_day1
      FROM cell_parts GROUP BY icustay_id""",
    "v_rbc": "SELECT c.subject_id, c.hadm_id, c.icustay_id, " + ", ".join(
        f"coalesce(p.{n} + i.{n}, p.{n}, i.{n}) AS {n}" for n in ("rbc", "rbc_day1", "rbc_or", "rbc_or_day1"))
        + " FROM cohort c LEFT JOIN cell_points p USING (icustay_id) LEFT JOIN cell_intervals i USING (icustay_id)",
    # Scores
    "gas": f"""SELECT stay AS icustay_id, charttime, max(value) FILTER (itemid = 100) AS specimen,
        max(valuenum) FILTER (itemid = 101 AND valuenum > 0 AND valuenum <= 100) AS fio2,
        max(valuenum) FILTER (itemid = 102 AND valuenum > 0 AND valuenum <= 800) AS po2
      FROM ({window('gasevents', 24)}) GROUP BY stay, charttime HAVING po2 IS NOT NULL""",
    "oxygen": """SELECT icustay_id, charttime AS at, max(CASE
        WHEN itemid = 11 AND valuenum > 0 AND valuenum <= 1 THEN valuenum * 100
        WHEN itemid = 11 AND valuenum >= 21 AND valuenum <= 100 THEN valuenum
        WHEN itemid IN (12, 13, 14) THEN valuenum
        WHEN itemid = 15 AND valuenum > 0.2 AND valuenum < 1 THEN valuenum * 100 END) AS fio2_chartevents
      FROM chart0 WHERE itemid BETWEEN 11 AND 15 GROUP BY icustay_id, charttime""",
    "ratio": """SELECT g.icustay_id, g.charttime, g.po2, g.fio2, o.fio2_chartevents,
        CASE WHEN coalesce(g.fio2, o.fio2_chartevents) > 0 AND coalesce(g.fio2, o.fio2_chartevents) < 100
             THEN 100 * g.po2 / coalesce(g.fio2, o.fio2_chartevents) END AS pao2fio2
      FROM gas g LEFT JOIN oxygen o ON o.icustay_id = g.icustay_id
        AND o.at BETWEEN g.charttime - INTERVAL 4 HOUR AND g.charttime
      WHERE coalesce(g.specimen, 'ART') = 'ART'
      QUALIFY row_number() OVER (PARTITION BY g.icustay_id ORDER BY g.charttime DESC, o.at DESC NULLS LAST) = 1""",
    "coma_all": """SELECT icustay_id, charttime, max(valuenum) FILTER (itemid = 200) AS m,
        max(valuenum) FILTER (itemid = 201) AS v, max(valuenum) FILTER (itemid = 202) AS e
      FROM gcsevents GROUP BY icustay_id, charttime""",
    "coma_day": f"""SELECT stay AS icustay_id, charttime, max(valuenum) FILTER (itemid = 200) AS m,
        max(valuenum) FILTER (itemid = 201) AS v, max(valuenum) FILTER (itemid = 202) AS e
      FROM ({window('gcsevents', 24)}) GROUP BY stay, charttime""",
}


def worst_coma(source: str) -> str:
    """Previous record by self-join on the position, less than six hours old."""
    ranked = f"SELECT *, row_number() OVER (PARTITION BY icustay_id ORDER BY charttime) AS n FROM {source}"
    return f"""SELECT a.icustay_id, CAST(min(CASE
        WHEN a.v = 0 OR (a.v IS NULL AND b.v = 0) THEN 15
        WHEN b.v = 0 THEN coalesce(a.m, 6) + coalesce(a.v, 5) + coalesce(a.e, 4)
        ELSE coalesce(a.m, b.m, 6) + coalesce(a.v, b.v, 5) + coalesce(a.e, b.e, 4) END) AS DOUBLE) AS mingcs
      FROM ({ranked}) a LEFT JOIN ({ranked}) b ON b.icustay_id = a.icustay_id AND b.n = a.n - 1
        AND b.charttime > a.charttime - INTERVAL 6 HOUR
      GROUP BY a.icustay_id"""


def steps(column: str, op: str, bounds: list[tuple[float, int]]) -> str:
    cases = " ".join(f"WHEN {column} {op} {b} THEN {p}" for b, p in bounds)
    return f"CASE WHEN {column} IS NULL THEN NULL {cases} ELSE 0 END"


CTES |= {
    "coma": worst_coma("coma_day"),
    "organ_labs": f"""SELECT stay AS icustay_id, max(valuenum) FILTER (itemid <= 3 AND valuenum <= 150) AS bili,
        max(valuenum) FILTER (itemid BETWEEN 4 AND 7 AND valuenum <= 150) AS crea,
        min(valuenum) FILTER (itemid BETWEEN 8 AND 11 AND valuenum <= 10000) AS plat
      FROM ({window('lab0', 24, 'AND e.valuenum > 0')}) GROUP BY stay""",
    "pressure": f"SELECT stay AS icustay_id, min(valuenum) AS bp FROM ({window('chart0', 24)})"
                f" WHERE itemid IN {ids(mapped.CONCEPTS.mean_pressure)} GROUP BY stay",
    "urine": f"SELECT stay AS icustay_id, sum(value) AS uo FROM ({window('outputevents', 24)})"
             " WHERE itemid IN (0, 1, 2) GROUP BY stay",
    "v_sofa": f"""SELECT subject_id, hadm_id, icustay_id, coalesce(respiration, 0) + coalesce(coagulation, 0)
        + coalesce(liver, 0) + coalesce(cardiovascular, 0) + coalesce(cns, 0) + coalesce(renal, 0) AS sofa,
        respiration, coagulation, liver, cardiovascular, cns, renal
      FROM (SELECT c.subject_id, c.hadm_id, c.icustay_id,
        {steps('pao2fio2', '<', [(300, 2), (400, 1)])} AS respiration,
        {steps('plat', '<', [(20, 4), (50, 3), (100, 2), (150, 1)])} AS coagulation,
        {steps('bili', '>=', [(12, 4), (6, 3), (2, 2), (1.2, 1)])} AS liver,
        {steps('bp', '<', [(70, 1)])} AS cardiovascular,
        {steps('mingcs', '<', [(6, 4), (10, 3), (13, 2), (15, 1)])} AS cns,
        CASE WHEN crea >= 5 OR uo < 200 THEN 4 WHEN crea >= 3.5 OR uo < 500 THEN 3 WHEN crea >= 2 THEN 2
             WHEN crea >= 1.2 THEN 1 WHEN coalesce(uo, crea) IS NOT NULL THEN 0 END AS renal
      FROM cohort c LEFT JOIN ratio USING (icustay_id) LEFT JOIN organ_labs USING (icustay_id)
        LEFT JOIN pressure USING (icustay_id) LEFT JOIN urine USING (icustay_id)
        LEFT JOIN coma USING (icustay_id))""",
    # Notes and body measures
    "reports": f"""SELECT c.subject_id, c.hadm_id, c.icustay_id, n.row_id, n.chartdate,
        {CHARTTIME} AS charttime, {NOTE_FIELDS}
      FROM cohort c LEFT JOIN noteevents n ON n.hadm_id = c.hadm_id AND n.category = 'Echo'
        AND n.chartdate <= c.vent_starttime
        AND n.chartdate >= date_trunc('day', c.vent_starttime - INTERVAL 7 DAY)""",
    "v_echo": """SELECT *, 703.0 * (weight_first / (height_first * height_first)) AS bmi FROM reports
      QUALIFY row_number() OVER (PARTITION BY icustay_id ORDER BY charttime ASC NULLS LAST, row_id) = 1""",
    "weights": f"""SELECT stay AS icustay_id, quantile_cont(valuenum, 0.5) FILTER (itemid = 16) AS weight_admit,
        quantile_cont(valuenum, 0.5) FILTER (itemid IN (11, 12, 13, 14, 15, 17)) AS weight_daily
      FROM ({window('chart0', 24, 'AND e.valuenum <> 0')}) GROUP BY stay""",
    "heights": """SELECT c.icustay_id, quantile_cont(CASE itemid WHEN 18 THEN valuenum * 2.54 ELSE valuenum END, 0.5)
        AS height_chart FROM cohort c JOIN chart0 e ON e.subject_id = c.subject_id AND e.charttime <= c.outtime
      WHERE itemid IN (18, 19) AND valuenum <> 0 GROUP BY c.icustay_id""",
    "v_bmi": f"""SELECT icustay_id, weight / (height * height) AS bmi, height, weight, height_chart, weight_admit,
        weight_daily, height_echo, weight_echo
      FROM (SELECT *, {HALF_UP.format('coalesce(weight_admit, weight_daily, weight_echo)')} AS weight,
              coalesce(height_chart, height_echo) / 100.0 AS height
            FROM (SELECT c.icustay_id, height_chart, weight_admit, weight_daily,
                    2.54 * height_first AS height_echo, 0.453592 * weight_first AS weight_echo
                  FROM cohort c LEFT JOIN weights USING (icustay_id) LEFT JOIN heights USING (icustay_id)
                    LEFT JOIN v_echo e ON e.icustay_id = c.icustay_id))""",
}


def rounded(view: str, doubles: list[str]) -> str:
    return f"SELECT * REPLACE ({', '.join(r6(d, d) for d in doubles)}) FROM {view}"


COHORT_DOUBLES = [
    "age", "aline_time_day", "vent_day", "vent_free_day", "vent_off_day", "icu_los_day",
    "hospital_los_day", "mort_day", "mort_day_censored"]
VALUES = [f"{output_name(n)}_first" for n in PANEL]
MARKS = [f"{output_name(n)}_abnormal_flg" for n in PANEL]
FINAL_LABS = [f"{output_name(n)}_first" for n in labels_of(mapped.LAB_ITEMS)]
NOTE_OUT = ["bmi", *NOTE_NUMBERS]


def drug_doubles(name: str) -> list[str]:
    return [f"{name}_{part}" for part in ("start_day", "free_day", "day", "off_day")]


def final_sql() -> str:
    plain = ["subject_id", "hadm_id", "icustay_id", "gender_num", "day_icu_intime_num", "hour_icu_intime",
             "hosp_exp_flg", "icu_exp_flg", "day_28_flg", "censor_flg", "aline_flg", "service_unit"]
    doubles = ["age", "icu_los_day", "hospital_los_day", "mort_day", "mort_day_censored", "aline_time_day"]
    return "SELECT " + ", ".join([
        *[f"c.{n}" for n in plain], *[r6(f"c.{n}", n) for n in doubles],
        "c.intime AS icustay_intime", "c.outtime AS icustay_outtime",
        r6("b.weight", "weight_first"), r6("b.height", "height_first"), r6("b.bmi", "bmi"),
        "s.sofa AS sofa_first",
        *[r6(f"v.{a}", b) for a, b in study.FINAL_VITALS.items()],
        *[r6(f"l.{n}", n) for n in study.FINAL_LABS],
        *[f"i.{a} AS {b}" for a, b in study.FINAL_ICD.items()],
    ]) + """ FROM cohort c LEFT JOIN v_sepsis a USING (icustay_id) LEFT JOIN v_sofa s ON s.icustay_id = c.icustay_id
      LEFT JOIN v_bmi b ON b.icustay_id = c.icustay_id LEFT JOIN v_vaso_flg x ON x.icustay_id = c.icustay_id
      LEFT JOIN v_icd i ON i.hadm_id = c.hadm_id LEFT JOIN v_vitals v ON v.hadm_id = c.hadm_id
      LEFT JOIN v_labs l ON l.hadm_id = c.hadm_id
      WHERE coalesce(a.angus, 0) = 0 AND coalesce(x.vaso_flg, 0) = 0"""


def wide_sql() -> str:
    cohort = [n for n in study.WIDE_COHORT_1 + study.WIDE_COHORT_2 if not n.startswith("icustay_")
              or n == "icustay_id"]
    labs = [f"{lab}_{kind}" for lab in study.WIDE_LABS for kind in ("first", "abnormal_flg")]

    def pick(alias, names):
        return [f"{alias}.{n}" if n.endswith(("_flg", "_aline")) else r6(f"{alias}.{n}", n) for n in names]

    return "SELECT " + ", ".join([
        *[r6(f"c.{n}", n) if n in COHORT_DOUBLES else f"c.{n}" for n in cohort],
        "c.intime AS icustay_intime", "c.outtime AS icustay_outtime",
        *pick("e", ["weight_first", "height_first", "bmi"]),
        "CAST(NULL AS INT) AS sapsi_first", "CAST(NULL AS INT) AS sofa_first",
        *pick("d", study.WIDE_VASO), *pick("n", study.WIDE_ANES), "CAST(NULL AS INT) AS sepsis_flg",
        *[f"i.{a} AS {b}" for a, b in list(study.FINAL_ICD.items())[:9]],
        *[r6(f"v.{a}", b) for a, b in study.WIDE_VITALS.items()],
        *pick("p", [*study.WIDE_CRIT, *labs]), *[f"s.{n}" for n in study.WIDE_STATUS],
    ]) + """ FROM cohort c LEFT JOIN v_echo e USING (icustay_id) LEFT JOIN v_vaso d ON d.icustay_id = c.icustay_id
      LEFT JOIN v_vaso_flg x ON x.icustay_id = c.icustay_id LEFT JOIN v_anes n ON n.icustay_id = c.icustay_id
      LEFT JOIN v_icd i ON i.hadm_id = c.hadm_id LEFT JOIN v_vitals v ON v.hadm_id = c.hadm_id
      LEFT JOIN v_panel p ON p.hadm_id = c.hadm_id LEFT JOIN v_codestatus s ON s.icustay_id = c.icustay_id
      WHERE coalesce(x.vaso_flg, 0) = 0"""


CTES |= {"v_data": final_sql(), "v_data_full": wide_sql()}
STORED = {
    "cohort": "cohort", "echodata": "v_echo", "icd": "v_icd", "labs": "v_labs", "sofa": "v_sofa",
    "vitals": "v_vitals", "vaso_flg": "v_vaso_flg", "bmi": "v_bmi", "sepsis": "v_sepsis",
    "anaesthesia": "v_anes", "codestatus": "v_codestatus", "labs_all": "v_panel", "rbc": "v_rbc",
    "vaso": "v_vaso", "data": "v_data", "data_full": "v_data_full",
}

BODIES: dict[str, str] = {
    "scalar_time": f"""SELECT event_id, CAST(dayofweek(ts) AS INT) AS day_num, lower(dayname(ts)) AS day_name,
      CAST(hour(ts) AS INT) AS hour_num, date_trunc('day', ts)::TIMESTAMP AS day_start,
      {r6(days("date_trunc('day', ts)::TIMESTAMP", 'ts'), 'day_share')},
      {r6(days("TIMESTAMP '1990-05-17 12:00:00'", 'ts') + ' / 365.242', 'age')},
      ts + INTERVAL 2 HOUR AS in_two_hours, ts - INTERVAL 7 DAY AS week_before,
      ts - INTERVAL 16 YEAR AS years_before,
      {flag("ts <= date_trunc('day', ts) + INTERVAL 12 HOUR")} AS morning FROM ev""",
    "scalar_text": f"""SELECT row_id, strftime(chartdate, '%d-%m-%Y') AS date_text, {CLOCK} AS clock,
      {CHARTTIME} AS charttime, strftime(chartdate, '%d-%m-%Y') || ({CLOCK}) AS stamp,
      text[1:10] AS head, contains(text, '*') AS masked,
      {', '.join([r6(number(p), n) for n, p in NOTE_NUMBERS.items()])},
      {', '.join([f"{regex(p)} AS {n}" for n, p in NOTE_TEXTS.items()])} FROM noteevents""",
    "scalar_numeric": f"""SELECT event_id, {r6('(valuenum - 32) / 1.8', 'celsius')},
      {r6('valuenum * 2.54', 'centimetres')}, {r6('valuenum * 0.453592', 'kilograms')},
      {HALF_UP.format('valuenum / 3')} AS rounded,
      {r6('valuenum / nullif((itemid / 10.0) * (itemid / 10.0), 0)', 'bmi_metric')},
      {r6('703.0 * (valuenum / ((itemid + 61.3::DOUBLE) * (itemid + 61.3::DOUBLE)))', 'bmi_imperial')},
      {r6('coalesce(CASE WHEN itemid > 10 THEN valuenum END, -valuenum, 0.0)', 'fallback')},
      {r6('''CASE WHEN valuenum IS NULL AND itemid >= 10 THEN NULL
           ELSE coalesce(valuenum, 0) + CASE WHEN itemid < 10 THEN itemid ELSE 0 END END''', 'known_sum')},
      {r6('CASE WHEN valuenum > 0 AND valuenum < 100 THEN 9000.0 / valuenum END', 'oxygen')},
      2 // 24 AS whole_division, {r6('valuenum / nullif(itemid, 0)', 'safe_ratio')} FROM chart0""",
    "null_logic": f"""SELECT event_id, CASE WHEN rate > 50 THEN 'high' WHEN rate > 0 THEN 'low'
        WHEN rate = 0 THEN 'zero' END AS band, {flag('rate > 0')} AS running,
      {flag("stopped <> 'Stopped'")} AS other_stop,
      {flag('rate IS NULL OR stopped IS NOT NULL')} AS open_or_marked,
      {flag('itemid NOT IN (0) AND rate <= 10')} AS small_other,
      CASE WHEN stopped IS NOT NULL AND rate IS NULL THEN 1 END AS stopped_unknown FROM inputevents_cv""",
    "scan_chart_items": """SELECT event_id, icustay_id, charttime, itemid, valuenum FROM chart0
      WHERE itemid < 3 AND valuenum IS NOT NULL""",
    "scan_lab_items": f"""SELECT event_id, subject_id, charttime, itemid, valuenum, flag FROM lab0
      WHERE itemid IN {ids(mapped.LAB_ITEMS)}""",
    "item_label": f"""SELECT event_id, itemid, {lab_case(mapped.LAB_ITEMS)} AS label, valuenum FROM lab0
      WHERE itemid IN {ids(mapped.LAB_ITEMS)}""",
    "unit_clean": f"""SELECT event_id, {lab_case(mapped.VITAL_ITEMS)} AS vital,
      {r6('''CASE WHEN itemid IN (6, 14) THEN (valuenum - 32) / 1.8 WHEN itemid BETWEEN 3 AND 18 THEN valuenum END''', 'vital_value')},
      {r6('''CASE WHEN itemid = 11 AND valuenum > 0 AND valuenum <= 1 THEN valuenum * 100
          WHEN itemid = 11 AND valuenum >= 21 AND valuenum <= 100 THEN valuenum
          WHEN itemid IN (12, 13, 14) THEN valuenum
          WHEN itemid = 15 AND valuenum > 0.2 AND valuenum < 1 THEN valuenum * 100 END''', 'fio2')} FROM chart0""",
    "sample_limit": "SELECT event_id, subject_id, itemid, valuenum FROM lab0 ORDER BY event_id LIMIT 5",
    "cohort_base": "SELECT * FROM base",
    "cohort_flags": rounded("flagged", COHORT_DOUBLES),
    "cohort_select": rounded("cohort", COHORT_DOUBLES),
    "cohort_attrition": """SELECT step, name, CAST(remaining AS BIGINT) AS remaining FROM (
      SELECT 1 AS step, 'all_stays' AS name, count(*) AS remaining FROM icustays
        JOIN patients USING (subject_id) JOIN admissions USING (hadm_id) UNION ALL
      SELECT 2, 'adult', count(*) FROM flagged UNION ALL
      SELECT 3, 'first_stay', count(*) FROM flagged WHERE stay_num = 1 UNION ALL
      SELECT 4, 'long_enough', count(*) FROM flagged WHERE stay_num = 1 AND icu_los_day > 1 UNION ALL
      SELECT 5, 'not_exposed_at_intake', count(*) FROM flagged WHERE stay_num = 1 AND icu_los_day > 1
        AND initial_aline_flg = 0 UNION ALL
      SELECT 6, 'ventilated', count(*) FROM flagged WHERE stay_num = 1 AND icu_los_day > 1
        AND initial_aline_flg = 0 AND vent_starttime IS NOT NULL UNION ALL
      SELECT 7, 'ventilated_early', count(*) FROM flagged WHERE stay_num = 1 AND icu_los_day > 1
        AND initial_aline_flg = 0 AND vent_starttime < intime + INTERVAL 48 HOUR UNION ALL
      SELECT 8, 'service', count(*) FROM cohort)""",
    "first_event": "SELECT * FROM placed",
    "interval_summary": f"""SELECT icustay_id, {r6('vent_day', 'total_day')}, vent_starttime AS first_start,
      vent_endtime AS last_end FROM vent""",
    "asof_service": """SELECT i.hadm_id, i.icustay_id, i.intime + INTERVAL 2 HOUR AS at, s.curr_service,
      s.transfertime FROM icustays i LEFT JOIN served s USING (icustay_id)""",
    "order_flag": f"""SELECT i.icustay_id, CASE WHEN starttime_aline IS NULL
          THEN {flag("vent_starttime <= intime + INTERVAL 2 HOUR")}
        WHEN starttime_aline > intime + INTERVAL 1 HOUR AND vent_starttime IS NOT NULL
          THEN {flag('vent_starttime <= starttime_aline')} END AS vent_b4_aline
      FROM icustays i LEFT JOIN placed USING (icustay_id) LEFT JOIN vent USING (icustay_id)""",
    "last_value_pivot": "SELECT l.*, " + ", ".join(
        r6(f"v.{n}", n) for n in ("map", "temperature", "heartrate", "cvp", "spo2"))
        + " FROM v_labs l JOIN v_vitals v USING (hadm_id)",
    "lookback_join": """SELECT c.subject_id, c.icustay_id, c.vent_starttime, e.event_id, e.charttime, e.itemid, e.valuenum
      FROM chart0 e JOIN cohort c ON c.subject_id = e.subject_id
        AND e.charttime BETWEEN c.vent_starttime - INTERVAL 24 HOUR AND c.vent_starttime""",
    "lookback_left": """SELECT c.subject_id, c.icustay_id, c.vent_starttime, e.event_id, e.charttime, e.itemid, e.valuenum
      FROM cohort c LEFT JOIN lab0 e ON c.subject_id = e.subject_id
        AND e.charttime BETWEEN c.vent_starttime - INTERVAL 24 HOUR AND c.vent_starttime""",
    "windowed_sum": f"SELECT c.icustay_id, {r6('uo', 'urineoutput')} FROM cohort c LEFT JOIN urine USING (icustay_id)",
    "median_measure": f"""SELECT c.icustay_id, {r6('height_chart', 'height_chart')}
      FROM cohort c LEFT JOIN heights USING (icustay_id)""",
    "stay_median": f"""SELECT icustay_id, {r6('quantile_cont(valuenum, 0.5)', 'median')} FROM chart0
      WHERE valuenum IS NOT NULL GROUP BY icustay_id""",
    "lab_range": f"""SELECT hadm_id, {lab_case(mapped.PANEL_ITEMS)} AS label, {r6('min(valuenum)', 'lowest')},
      {r6('max(valuenum)', 'highest')}, {r6('quantile_cont(valuenum, 0.5)', 'median')} FROM lab0 GROUP BY 1, 2""",
    "paired_pivot": f"""SELECT subject_id, charttime, max(value) FILTER (itemid = 100) AS specimen,
      {r6('max(valuenum) FILTER (itemid = 101 AND valuenum > 0 AND valuenum <= 100)', 'fio2')},
      {r6('max(valuenum) FILTER (itemid = 102 AND valuenum > 0 AND valuenum <= 800)', 'po2')}
      FROM gasevents GROUP BY subject_id, charttime
      HAVING max(valuenum) FILTER (itemid = 102 AND valuenum > 0 AND valuenum <= 800) IS NOT NULL""",
    "lab_panel": f"""SELECT subject_id, hadm_id, {r6('hct_med', 'hct_med')}, {r6('hct_lowest', 'hct_lowest')},
      {r6('hct_highest', 'hct_highest')}, {', '.join(r6(v, v) for v in VALUES)} FROM v_panel""",
    "lab_abnormal": f"SELECT hadm_id, hct_abnormal_flg, {', '.join(MARKS)} FROM v_panel",
    "code_flags": "SELECT * FROM v_icd",
    "code_flags_trimmed": "SELECT * FROM v_icd_trimmed",
    "code_rule_score": "SELECT * FROM v_sepsis",
    "ever_exposed": "SELECT * FROM v_vaso_flg",
    "status_history": "SELECT * FROM v_codestatus",
    "forward_fill": """SELECT *, last_value(rate IGNORE NULLS) OVER (PARTITION BY icustay_id, itemid
      ORDER BY charttime ROWS UNBOUNDED PRECEDING) AS carried_rate FROM dose""",
    "rate_episodes": "SELECT * FROM cv_episodes",
    "order_intervals": "SELECT * FROM orders",
    "merge_intervals": "SELECT * FROM mv_merged",
    "anti_overlap": """SELECT DISTINCT icustay_id, starttime FROM orders a WHERE NOT EXISTS (
      SELECT 1 FROM orders b WHERE b.icustay_id = a.icustay_id AND b.starttime < a.starttime
        AND b.endtime >= a.starttime)""",
    "episode_sequence": """SELECT icustay_id, starttime, endtime,
      row_number() OVER (PARTITION BY icustay_id ORDER BY starttime) AS number FROM cv_merged""",
    "union_episodes": """SELECT icustay_id, row_number() OVER (PARTITION BY icustay_id ORDER BY starttime) AS number,
        starttime, endtime FROM cv_merged UNION
      SELECT icustay_id, row_number() OVER (PARTITION BY icustay_id ORDER BY starttime), starttime, endtime
        FROM mv_merged""",
    "episode_features": rounded("v_vaso", drug_doubles("vaso")),
    "episode_features_merged": rounded("v_vasox", drug_doubles("vaso")),
    "anaesthesia_features": rounded("v_anes", drug_doubles("anes")),
    "prorated_volume": rounded("v_rbc", ["rbc", "rbc_day1", "rbc_or", "rbc_or_day1"]),
    "asof_ratio": rounded("ratio", ["po2", "fio2", "fio2_chartevents", "pao2fio2"]),
    "asof_values": """SELECT l.hadm_id AS icustay_id, l.event_id AS lab_id, l.charttime AS lab_time,
        c.valuenum, c.charttime
      FROM lab0 l LEFT JOIN chart0 c ON c.icustay_id = l.hadm_id
        AND c.charttime BETWEEN l.charttime - INTERVAL 4 HOUR AND l.charttime
      QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY c.charttime DESC NULLS LAST, c.event_id DESC) = 1""",
    "asof_unknown": """SELECT l.k AS icustay_id, l.lab_id, l.lab_time, c.valuenum, c.charttime
      FROM (SELECT CASE WHEN event_id % 5 <> 0 THEN hadm_id END AS k, event_id AS lab_id, charttime AS lab_time
        FROM lab0) l
      LEFT JOIN (SELECT CASE WHEN event_id % 7 <> 0 THEN icustay_id END AS k, event_id, valuenum,
        CASE WHEN event_id % 11 <> 0 THEN charttime END AS charttime FROM chart0) c
        ON c.k = l.k AND c.charttime <= l.lab_time
      QUALIFY row_number() OVER (PARTITION BY l.lab_id ORDER BY c.charttime DESC NULLS LAST, c.event_id DESC) = 1""",
    "merge_unknown": """SELECT icustay_id, min(starttime) AS starttime, max(endtime) AS endtime FROM (
      SELECT *, sum(CASE WHEN reach IS NULL OR starttime > reach THEN 1 ELSE 0 END)
        OVER (PARTITION BY icustay_id ORDER BY starttime, endtime ROWS UNBOUNDED PRECEDING) AS island
      FROM (SELECT *, max(endtime) OVER (PARTITION BY icustay_id ORDER BY starttime, endtime
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
        FROM orders WHERE starttime <= endtime AND icustay_id IS NOT NULL AND hour(starttime) % 4 <> 0))
      GROUP BY icustay_id, island""",
    "anti_unknown": """SELECT DISTINCT k AS icustay_id, starttime
      FROM (SELECT CASE WHEN hour(starttime) % 4 <> 0 THEN icustay_id END AS k, * FROM orders WHERE starttime <= endtime) a
      WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE hour(b.starttime) % 4 <> 0 AND b.icustay_id = a.k
        AND b.starttime <= b.endtime AND b.starttime < a.starttime AND b.endtime >= a.starttime)""",
    "prev_value_score": worst_coma("coma_all"),
    "organ_score": "SELECT * FROM v_sofa",
    "note_fields": rounded("v_echo", NOTE_OUT),
    "body_measure": rounded("v_bmi", ["bmi", "height", "weight", "height_chart", "weight_admit", "weight_daily",
                                      "height_echo", "weight_echo"]),
    "assemble_final": "SELECT * FROM v_data",
    "assemble_wide": "SELECT * FROM v_data_full",
    "assemble_scored": """SELECT c.subject_id, c.hadm_id, c.icustay_id,
        CAST(c.icustay_id % 20 AS INT) AS sapsi_first,
        CASE WHEN c.icustay_id % 20 > 3 THEN CAST(c.icustay_id % 20 - 3 AS INT) END AS sofa_first,
        CASE WHEN c.icustay_id % 20 % 4 < 2 THEN CAST(c.icustay_id % 20 % 4 AS INT) END AS sepsis_flg,
        d.vaso_flg, n.anes_flg
      FROM cohort c JOIN v_vaso d USING (icustay_id) JOIN v_anes n ON n.icustay_id = c.icustay_id
        JOIN v_vaso_flg x ON x.icustay_id = c.icustay_id
      WHERE coalesce(x.vaso_flg, 0) = 0 AND c.icustay_id % 20 % 4 <> 1""",
    "build_all": " UNION ALL ".join(
        f"SELECT '{name}' AS view, count(*) AS n_rows, count(DISTINCT {study.VIEW_KEYS[name]}) AS n_keys FROM {view}"
        for name, view in STORED.items()),
}


def statement(body: str) -> str:
    """The body behind the CTEs it needs, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in CTES and word not in needed and re.search(rf"(FROM|JOIN) {word}\b", text):
                needed.add(word)
                visit(CTES[word])

    visit(body)
    ordered = [name for name in CTES if name in needed]
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + body


def numbers(name: str, view: str) -> str:
    """Every known number of a view, one to a row."""
    key = study.VIEW_KEYS[name]
    cells = f"TRY_CAST(CAST(COLUMNS(* EXCLUDE ({key})) AS VARCHAR) AS DOUBLE)"
    return f"""SELECT '{name}' AS view, id, field, {r6('value', 'value')} FROM (UNPIVOT (SELECT {key} AS id, {cells} FROM {view})
      ON COLUMNS(* EXCLUDE (id)) INTO NAME field VALUE value)"""


BROAD = """SELECT * FROM flagged WHERE stay_num = 1 AND icu_los_day > -1 AND initial_aline_flg = 0
      AND vent_starttime < intime + INTERVAL 100000 HOUR AND service_unit <> 'none'"""


def broad(body: str) -> str:
    """The statement over the broad cohort, without late exclusions."""
    return statement(body.split("WHERE coalesce(")[0]).replace(CTES["cohort"], BROAD)


ORACLES: dict[str, str] = {name: statement(body) for name, body in BODIES.items()} | {
    "build_rows": statement(" UNION ALL ".join(numbers(name, view) for name, view in STORED.items())),
    "final_broad": broad(final_sql()),
    "wide_broad": broad(wide_sql()),
    "ratio_broad": broad(BODIES["asof_ratio"]),
    "overlap_pairs": statement("""SELECT o.icustay_id, o.linkorderid, o.starttime, o.endtime,
        v.starttime AS vent_starttime, v.endtime AS vent_endtime
      FROM orders o JOIN ventdurations v ON v.icustay_id = o.icustay_id
      WHERE o.starttime <= o.endtime AND v.starttime <= v.endtime AND o.starttime <= v.endtime AND v.starttime <= o.endtime"""),
    "lookback_thinned": statement(BODIES["lookback_join"]),
    "grouped_scan": statement(BODIES["scan_lab_items"]),
}
