"""Run parameters of the registered queries over the driver fixtures."""

import datetime as _dt

from outletlab import conf

COUNTRY = "ie"
SALES_ORGS, COMPANY_CODES = conf.COUNTRY_INFO[COUNTRY]
ACCOUNT_GROUPS = ["Z001"]
# Current run and the run that produced the previous snapshot.
AS_OF = _dt.date(2001, 11, 1)
PREVIOUS_AS_OF = _dt.date(2001, 9, 1)
RUN_PARDT = "20011101"
PREVIOUS_PARDT = "20010901"
