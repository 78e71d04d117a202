"""Parameters of the equity report and the two ways it is set up."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta

from eodledger.functions.times import half_hour_floor_of


@dataclass(frozen=True)
class Variant:
    """Everything that differs between the two tenant set-ups."""

    sixth_product: str
    sixth_label: str
    lower_product_label: bool
    deposit_codes: tuple[int, ...]
    withdrawal_codes: tuple[int, ...]
    points_code: int
    cfd_code: int
    rate_groups: tuple[int, int, int, int, int, int]
    wallet_code: int
    recent_names_skip_mam: bool
    other_types_excluded: bool
    category_wallet_code: int = 9

    @property
    def products(self) -> dict[str, str]:
        """Volume column to symbol-group label."""
        return {
            "forex_vol": "forex",
            "bullion_vol": "bullion",
            "oil_vol": "oil",
            "cfd_vol": "cfd",
            "crypto_vol": "crypto",
            f"{self.sixth_product}_vol": self.sixth_label,
        }

    @property
    def rebate_groups(self) -> dict[str, int]:
        """Rebate column to symbol-group id; the first is required."""
        names = ("forex", "bullion", "oil", "cfd", "crypto", self.sixth_product)
        return {f"{n}_rebate": g for n, g in zip(names, self.rate_groups)}


# Fixed values of the two set-ups.
VARIANT_A = Variant(
    sixth_product="fx_exotics",
    sixth_label="fx exotics",
    lower_product_label=True,
    deposit_codes=(1,),
    withdrawal_codes=(2,),
    points_code=5,
    cfd_code=8,
    rate_groups=(6, 7, 8, 10, 11, 13),
    wallet_code=3,
    recent_names_skip_mam=False,
    other_types_excluded=False,
)
VARIANT_B = Variant(
    sixth_product="shares",
    sixth_label="shares",
    lower_product_label=False,
    deposit_codes=(1, 6),
    withdrawal_codes=(2, 5),
    points_code=13,
    cfd_code=7,
    rate_groups=(1, 2, 3, 4, 5, 17),
    wallet_code=9,
    recent_names_skip_mam=True,
    other_types_excluded=True,
)


@dataclass(frozen=True)
class ReportConfig:
    report_time: datetime
    variant: Variant = VARIANT_A
    excluded_servers: tuple[str, ...] = ()
    demo_types: tuple[int, ...] = (2, 6)
    wallet_types: tuple[int, ...] = (3,)
    other_types: tuple[int, ...] = (-1,)
    extra_transfer_type: int = 13
    # The zone of the report's wall time is not published; set it for real use.
    report_tz: str = "Europe/Athens"
    run_time: datetime | None = None
    # The month sits where minutes would be expected; kept so that old and new rows agree.
    insert_time_format: str = "yyyy-MM-dd HH:MM:ss"
    price_days: int = 14
    grace: timedelta = field(default=timedelta(minutes=20))

    @property
    def day(self) -> date:
        return self.report_time.date()

    @property
    def day_start(self) -> datetime:
        return datetime.combine(self.day, time())

    @property
    def day_before(self) -> date:
        return self.day - timedelta(days=1)

    @property
    def previous_start(self) -> datetime:
        return self.day_start - timedelta(days=1)

    @property
    def month_back(self) -> date:
        """Same day of the previous month, or its last day."""
        year, month = (self.day.year, self.day.month - 1) if self.day.month > 1 else (self.day.year - 1, 12)
        last = (date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
        return date(year, month, min(self.day.day, last))

    @property
    def known_before(self) -> datetime:
        return self.report_time + self.grace

    @property
    def bucket(self) -> datetime:
        return half_hour_floor_of(self.report_time)

    @property
    def excluded_types(self) -> tuple[int, ...]:
        return self.demo_types + (self.other_types if self.variant.other_types_excluded else ())
