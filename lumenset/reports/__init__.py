"""Reports: tables as HTML pages and figures as data with inline SVG."""
