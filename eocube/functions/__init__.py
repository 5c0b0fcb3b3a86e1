"""Column functions: missing values, calendar, geodesy, projections, text."""
