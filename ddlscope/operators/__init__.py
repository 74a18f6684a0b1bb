"""Operators from DataFrame to DataFrame. `lead` names further key columns, such as a snapshot date."""
