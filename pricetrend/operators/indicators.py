"""The ten technical indicators, the price change and the indicator lags.

Definitions (C, H, L = close, high, low; frames end at the current bar and a
value is NULL until its frame holds ``n`` observations):

  sma_10     mean of the last 10 C
  wma_10     sum_i i*C_i / 55, i = 1 (oldest) .. 10 (newest)
  stck       100*(C - LL14) / (HH14 - LL14)
  stcd       3-bar mean of stck (all three present)
  williams_r 100*(C - HH14) / (HH14 - LL14)  (= stck - 100; never -0.0)
  macd       EMA12(C) - EMA26(C), alpha = 2/(n+1), seeded with the first C,
             first value at bar 26
  rsi        Wilder EMA (alpha 1/14) of up and down moves (bar 1 counts as
             0/0); 100 - 100/(1 + up/dn), 100 when dn = 0; first at bar 14
  cci        (TP - SMA20(TP)) / (0.015 * MAD20), TP = (H+L+C)/3, MAD about
             the frame's own mean
  ad_osc     (H - C_prev) / (H - L)
  momentum   100 * (C - C_12) / C_12  (rate of change)

Any zero divisor gives NULL. A missing close is no observation: the averages
of MACD run over the observed closes only (seed, weights and warm-up count
those), and a bar without a close carries the last value on. Windows over a
fixed number of bars need all of them. A move to or from a missing close counts
as none for RSI.

Execution: one shuffle into (symbol, block) partitions with a halo (see
``sequence``); the EMAs use the blocked closed form with a per-block carry
joined back on (symbol, block). Only the asked-for indicators are computed.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricetrend.functions.columns import full_window, safe_div
from pricetrend.operators import ema
from pricetrend.operators.scan import previous, sums_before
from pricetrend.operators.sequence import block_rows

INDICATORS = ["sma_10", "wma_10", "stck", "stcd", "williams_r", "macd", "rsi", "cci",
              "ad_osc", "momentum"]
LAGGED = ["stck", "stcd", "williams_r", "macd", "rsi", "cci", "ad_osc"]
MACD_SNAP = 1e-12


@dataclass(frozen=True)
class IndicatorParams:
    sma: int = 10
    wma: int = 10
    stoch: int = 14
    stoch_smooth: int = 3
    williams: int = 14
    macd_fast: int = 12
    macd_slow: int = 26
    rsi: int = 14
    cci: int = 20
    cci_constant: float = 0.015
    roc: int = 12
    block: int = 512

    @property
    def halo(self) -> int:
        """Rows of look-back the first row of a block needs, lags included."""
        return max(self.sma - 1, self.wma - 1, self.stoch + self.stoch_smooth - 1,
                   self.williams, self.cci, self.roc, 2)

    def resolved(self) -> "IndicatorParams":
        """Smallest power-of-two block >= ``block`` meeting every EMA bound."""
        from dataclasses import replace
        b = self.block
        while b <= 1 << 20:
            try:
                replace(self, block=b).validate()
                return replace(self, block=b)
            except ValueError:
                b *= 2
        raise ValueError("no block size satisfies every EMA span (too fast and too slow together)")

    def validate(self) -> None:
        for a in (ema.alpha_span(self.macd_fast), ema.alpha_span(self.macd_slow),
                  ema.alpha_wilder(self.rsi)):
            ema.check_block(a, self.block)
        if self.halo >= self.block:
            raise ValueError("block must exceed the halo")


DEFAULT = IndicatorParams()


def _frame(w, n: int):
    return w.rowsBetween(-(n - 1), 0)


def _carries(rows: DataFrame, p: IndicatorParams, macd: bool, rsi: bool) -> DataFrame:
    """For each (symbol, blk) what the blocks before it hand on: ``_obs`` observed
    closes and the EMA values at their end.

    Works on one row per block, scanned in two levels (``scan``). A block may hold fewer
    observations than its length, so the MACD averages are summed over blocks by the same closed
    form as rows are, in super-blocks of twice the block length.
    """
    aggs = []
    if macd:
        seen = F.when(F.col("close").isNotNull(), F.col("pos"))
        aggs += [F.max("_k").alias("_n"), F.min_by("close", seen).alias("_first"),
                 F.max_by("_l12", "pos").alias("_l12"), F.max_by("_l26", "pos").alias("_l26")]
    if rsi:
        aggs += [F.max_by("_lup", "pos").alias("_cup"), F.max_by("_ldn", "pos").alias("_cdn")]
    ends = rows.where(~F.col("is_halo")).groupBy("symbol", "blk").agg(*aggs)
    handed = {"_cup": "_pup", "_cdn": "_pdn"} if rsi else {}
    out = [F.col("symbol").alias("_symbol"), F.col("blk").alias("_blk")]
    if macd:
        span = 2 * p.block
        total = sums_before(ends, "symbol", "blk", {"_n": "_obs"}).withColumn("_total", F.col("_obs") + F.col("_n"))
        total = total.withColumn("_super", F.floor(F.col("_total") / span)).withColumn("_e", F.col("_total") - F.col("_super") * span)
        inside = Window.partitionBy("symbol", "_super").orderBy("blk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        qs = {"12": 1.0 - ema.alpha_span(p.macd_fast), "26": 1.0 - ema.alpha_span(p.macd_slow)}
        power = lambda q, n: F.pow(F.lit(q), n.cast("double"))
        # A series' first observation is its seed; it travels on with the block that has it.
        seed = (F.col("_obs") == 0) & (F.col("_n") > 0)
        total = total.withColumns({f"_l{k}": F.col(f"_l{k}") + F.when(seed, power(q, F.col("_n")) * F.col("_first")).otherwise(0.0) for k, q in qs.items()})
        total = total.withColumns({f"_in{k}": power(q, F.col("_e")) * F.sum(F.col(f"_l{k}") * power(q, -F.col("_e"))).over(inside)
                                   for k, q in qs.items()})
        last = total.groupBy(F.col("symbol").alias("_s"), (F.col("_super") + 1).alias("_after")).agg(
            F.max("_total").alias("_was"), *[F.max_by(f"_in{k}", "blk").alias(f"_end{k}") for k in qs])
        ends = (total.join(last, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("_super") == F.col("_after")), "left")
                .withColumns({f"_all{k}": F.col(f"_in{k}") + F.coalesce(power(q, F.col("_total") - F.col("_was")) * F.col(f"_end{k}"), F.lit(0.0))
                              for k, q in qs.items()}))
        handed |= {f"_all{k}": f"_p{k}" for k in qs}
        out.append("_obs")
        # Before the first observation the carry that makes it the seed is its own value.
        out += [F.when(F.col("_obs") > 0, F.col(f"_p{k}")).otherwise(F.col("_first")).alias(f"_c{k}") for k in qs]
    if rsi:
        out += [F.col("_pup").alias("_cup"), F.col("_pdn").alias("_cdn")]
    return previous(ends, "symbol", "blk", handed).select(*out)


def indicator_panel(numbered: DataFrame, p: IndicatorParams = DEFAULT, materialize: bool = True,
                    indicators: Iterable[str] | None = None) -> DataFrame:
    """Bars with ``bar_no`` -> bars + price_change + indicators + their lags.

    ``indicators`` names the ones to compute (default: all ten); output keeps
    every input column and adds ``price_change``, the indicators and
    ``<ind>_lag`` for those of them that are lagged.

    ``materialize`` writes the block rows once before the carries are taken
    (shared checkpoint folder): the carry aggregate and the final pass both
    read them. Without MACD and RSI there are no carries and nothing is written.
    """
    p = p.resolved()
    want = [x for x in INDICATORS if indicators is None or x in set(indicators)]
    macd, rsi, stoch = "macd" in want, "rsi" in want, bool({"stck", "stcd"} & set(want))
    base = list(numbered.columns)
    w = Window.partitionBy("symbol", "blk").orderBy("bar_no")
    sofar = w.rowsBetween(Window.unboundedPreceding, 0)
    C, H, L = F.col("close"), F.col("high"), F.col("low")
    pos, halo, n = F.col("pos"), F.col("is_halo"), F.col("bar_no")
    c1 = F.lag(C, 1).over(w)

    def ranged(k: int) -> tuple[Column, Column, Column]:
        f = _frame(w, k)
        return F.max(H).over(f), F.min(L).over(f), F.least(F.count(H).over(f), F.count(L).over(f))

    # Pass A: bounded frames over the raw prices; only finished values leave it.
    made = {"price_change": C - c1}
    if "sma_10" in want:
        made["sma_10"] = full_window(F.avg(C).over(_frame(w, p.sma)), F.count(C).over(_frame(w, p.sma)), p.sma)
    if "wma_10" in want:
        weighted = sum((F.lit(float(p.wma - k)) * F.lag(C, k).over(w) for k in range(1, p.wma)), F.lit(float(p.wma)) * C)
        made["wma_10"] = full_window(weighted / F.lit(p.wma * (p.wma + 1) / 2.0), F.count(C).over(_frame(w, p.wma)), p.wma)
    if stoch:
        hh, ll, count = ranged(p.stoch)
        made["stck"] = full_window(safe_div(F.lit(100.0) * (C - ll), hh - ll), count, p.stoch)
    if "williams_r" in want:
        hh, ll, count = ranged(p.williams)
        made["williams_r"] = full_window(safe_div(F.lit(100.0) * (C - hh), hh - ll), count, p.williams)
    if "ad_osc" in want:
        made["ad_osc"] = safe_div(H - c1, H - L)
    if "momentum" in want:
        made["momentum"] = safe_div(C - F.lag(C, p.roc).over(w), F.lag(C, p.roc).over(w)) * F.lit(100.0)
    if "cci" in want:
        made["_tps"] = F.collect_list((H + L + C) / F.lit(3.0)).over(_frame(w, p.cci))
    if macd:
        made["_k"] = F.sum(F.when(C.isNotNull() & ~halo, 1).otherwise(0)).over(sofar)
    x = block_rows(numbered, p.block, p.halo).withColumns(made)
    if "cci" in want:
        tps, tp = F.col("_tps"), (H + L + C) / F.lit(3.0)
        mean = F.aggregate(tps, F.lit(0.0), lambda acc, t: acc + t) / F.size(tps)
        mad = F.aggregate(tps, F.lit(0.0), lambda acc, t: acc + F.abs(t - mean)) / F.size(tps)
        cci = F.when(F.size(tps) >= p.cci, safe_div(tp - mean, F.lit(p.cci_constant) * mad))
        x = x.withColumn("cci", cci).drop("_tps")

    if macd or rsi:
        # Pass B: sums inside the block, as the EMA value that the block alone gives.
        arsi = ema.alpha_wilder(p.rsi)
        local = {}
        if macd:
            for name, span in (("_l12", p.macd_fast), ("_l26", p.macd_slow)):
                alpha = ema.alpha_span(span)
                term = ema.local_term(C, alpha, F.col("_k"), F.lit(False), halo | C.isNull())
                local[name] = ema.local_value(F.sum(term).over(sofar), alpha, F.col("_k"))
        if rsi:
            d = F.col("price_change")
            moves = {"_lup": F.when(d > 0, d).otherwise(F.lit(0.0)), "_ldn": F.when(d < 0, -d).otherwise(F.lit(0.0))}
            for name, move in moves.items():
                local[name] = ema.local_value(F.sum(ema.local_term(move, arsi, pos, n == 1, halo)).over(sofar), arsi, pos)
        x = x.withColumns(local)
        if materialize:
            from pricetrend.session import cut_lineage
            x = cut_lineage(x, "blocks")
        carries = _carries(x, p, macd, rsi)
        x = x.join(carries, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("blk") == F.col("_blk")), "left")
        if macd:
            value = lambda k, span: F.col(f"_l{k}") + F.col(f"_c{k}") * F.pow(F.lit(1.0 - ema.alpha_span(span)), F.col("_k").cast("double"))
            e12, e26 = value("12", p.macd_fast), value("26", p.macd_slow)
            # The closed form leaves ~1e-16 relative noise where the recursion is exact
            # (a flat series has MACD 0 exactly); differences under 1e-12 of the slow
            # EMA are that noise and are snapped to zero so ties stay ties.
            line = F.when(F.abs(e12 - e26) <= F.lit(MACD_SNAP) * F.abs(e26), F.lit(0.0)).otherwise(e12 - e26)
            x = x.withColumn("macd", F.when(F.col("_obs") + F.col("_k") >= p.macd_slow, line))
        if rsi:
            last_halo = halo & (pos == p.block - 1)
            value = lambda k: F.when(last_halo, F.col("_c" + k)).when(~halo, ema.with_carry(F.col("_l" + k), F.col("_c" + k), arsi, pos))
            up, dn = value("up"), value("dn")
            strength = F.when(dn == 0, F.lit(100.0)).otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(up, dn)))
            x = x.withColumn("rsi", F.when(n >= p.rsi, strength))

    # Pass C: %D and the indicator lags (same partitioning, no new shuffle).
    more = {f"{c}_lag": F.lag(c, 1).over(w) for c in LAGGED if c in want and c != "stcd"}
    if "stcd" in want:
        smooth = lambda f: full_window(F.avg("stck").over(f), F.count("stck").over(f), p.stoch_smooth)
        more |= {"stcd": smooth(_frame(w, p.stoch_smooth)), "stcd_lag": smooth(w.rowsBetween(-p.stoch_smooth, -1))}
    x = x.withColumns(more) if more else x
    return x.where(~halo).select(*base, "price_change", *want, *[f"{c}_lag" for c in LAGGED if c in want])
