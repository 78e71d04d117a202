"""The end-of-day account-equity report, one module per group of its parts.

Every part is a function from a mapping of input frames and a ReportConfig to a frame.
Logins are turned into text before anything is ranked or grouped, so the (server,
login) exchange of each aggregate is the one its join to the report needs.
"""
