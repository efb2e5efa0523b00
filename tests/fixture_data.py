"""Small fixtures inlined from the reference (values only; tests never read the reference tree).

Fixed values: daily univariate series with a spike and a NaN, its cleaned
version, and the cleaned hourly multivariate series (4 variables)."""

SINGLE_COLUMNS = ['date', 'temperature']
SINGLE = [
    ('2023-01-01', 22.1),
    ('2023-01-02', 21.8),
    ('2023-01-03', 22.5),
    ('2023-01-04', 23.0),
    ('2023-01-05', 23.2),
    ('2023-01-06', 22.9),
    ('2023-01-07', 23.5),
    ('2023-01-08', 24.0),
    ('2023-01-09', 24.5),
    ('2023-01-10', 80.0),
    ('2023-01-11', 25.2),
    ('2023-01-12', 25.5),
    ('2023-01-13', 25.8),
    ('2023-01-14', 26.0),
    ('2023-01-15', None),
    ('2023-01-16', 26.2),
    ('2023-01-17', 26.5),
    ('2023-01-18', 26.8),
    ('2023-01-19', 27.0),
    ('2023-01-20', 27.2),
    ('2023-01-21', 27.5),
    ('2023-01-22', 27.8),
    ('2023-01-23', 28.0),
    ('2023-01-24', 28.2),
    ('2023-01-25', 28.5),
    ('2023-01-26', 28.8),
    ('2023-01-27', 29.0),
    ('2023-01-28', 29.2),
    ('2023-01-29', 29.5),
    ('2023-01-30', 29.8),
    ('2023-01-31', 30.0),
    ('2023-02-01', 30.2),
    ('2023-02-02', 30.5),
    ('2023-02-03', 30.8),
    ('2023-02-04', 31.0),
    ('2023-02-05', 31.2),
    ('2023-02-06', 31.5),
    ('2023-02-07', 31.8),
    ('2023-02-08', 32.0),
    ('2023-02-09', 32.2),
    ('2023-02-10', 32.5),
    ('2023-02-11', 32.8),
    ('2023-02-12', 33.0),
    ('2023-02-13', 33.2),
    ('2023-02-14', 33.5),
    ('2023-02-15', 33.8),
    ('2023-02-16', 34.0),
    ('2023-02-17', 34.2),
    ('2023-02-18', 34.5),
    ('2023-02-19', 34.8),
    ('2023-02-20', 35.0),
    ('2023-02-21', 35.2),
    ('2023-02-22', 35.5),
    ('2023-02-23', 35.8),
    ('2023-02-24', 36.0),
    ('2023-02-25', 36.2),
    ('2023-02-26', 36.5),
    ('2023-02-27', 36.8),
    ('2023-02-28', 37.0),
    ('2023-03-01', 37.2),
    ('2023-03-02', 37.5),
    ('2023-03-03', 37.8),
    ('2023-03-04', 38.0),
    ('2023-03-05', 38.2),
    ('2023-03-06', 38.5),
    ('2023-03-07', 38.8),
    ('2023-03-08', 39.0),
    ('2023-03-09', 39.2),
    ('2023-03-10', 39.5),
    ('2023-03-11', 39.8),
    ('2023-03-12', 40.0),
    ('2023-03-13', 40.2),
    ('2023-03-14', 40.5),
    ('2023-03-15', 40.8),
    ('2023-03-16', 41.0),
    ('2023-03-17', 41.2),
    ('2023-03-18', 41.5),
    ('2023-03-19', 41.8),
    ('2023-03-20', 42.0),
    ('2023-03-21', 42.2),
    ('2023-03-22', 42.5),
    ('2023-03-23', 42.8),
    ('2023-03-24', 43.0),
    ('2023-03-25', 43.2),
    ('2023-03-26', 43.5),
    ('2023-03-27', 43.8),
    ('2023-03-28', 44.0),
    ('2023-03-29', 44.2),
    ('2023-03-30', 44.5),
    ('2023-03-31', 44.8),
]

SINGLE_CLEANED = [
    ('2023-01-01', 22.1),
    ('2023-01-02', 21.8),
    ('2023-01-03', 22.5),
    ('2023-01-04', 23.0),
    ('2023-01-05', 23.2),
    ('2023-01-06', 22.9),
    ('2023-01-07', 23.5),
    ('2023-01-08', 24.0),
    ('2023-01-09', 24.5),
    ('2023-01-10', 24.85),
    ('2023-01-11', 25.2),
    ('2023-01-12', 25.5),
    ('2023-01-13', 25.8),
    ('2023-01-14', 26.0),
    ('2023-01-15', 26.1),
    ('2023-01-16', 26.2),
    ('2023-01-17', 26.5),
    ('2023-01-18', 26.8),
    ('2023-01-19', 27.0),
    ('2023-01-20', 27.2),
    ('2023-01-21', 27.5),
    ('2023-01-22', 27.8),
    ('2023-01-23', 28.0),
    ('2023-01-24', 28.2),
    ('2023-01-25', 28.5),
    ('2023-01-26', 28.8),
    ('2023-01-27', 29.0),
    ('2023-01-28', 29.2),
    ('2023-01-29', 29.5),
    ('2023-01-30', 29.8),
    ('2023-01-31', 30.0),
    ('2023-02-01', 30.2),
    ('2023-02-02', 30.5),
    ('2023-02-03', 30.8),
    ('2023-02-04', 31.0),
    ('2023-02-05', 31.2),
    ('2023-02-06', 31.5),
    ('2023-02-07', 31.8),
    ('2023-02-08', 32.0),
    ('2023-02-09', 32.2),
    ('2023-02-10', 32.5),
    ('2023-02-11', 32.8),
    ('2023-02-12', 33.0),
    ('2023-02-13', 33.2),
    ('2023-02-14', 33.5),
    ('2023-02-15', 33.8),
    ('2023-02-16', 34.0),
    ('2023-02-17', 34.2),
    ('2023-02-18', 34.5),
    ('2023-02-19', 34.8),
    ('2023-02-20', 35.0),
    ('2023-02-21', 35.2),
    ('2023-02-22', 35.5),
    ('2023-02-23', 35.8),
    ('2023-02-24', 36.0),
    ('2023-02-25', 36.2),
    ('2023-02-26', 36.5),
    ('2023-02-27', 36.8),
    ('2023-02-28', 37.0),
    ('2023-03-01', 37.2),
    ('2023-03-02', 37.5),
    ('2023-03-03', 37.8),
    ('2023-03-04', 38.0),
    ('2023-03-05', 38.2),
    ('2023-03-06', 38.5),
    ('2023-03-07', 38.8),
    ('2023-03-08', 39.0),
    ('2023-03-09', 39.2),
    ('2023-03-10', 39.5),
    ('2023-03-11', 39.8),
    ('2023-03-12', 40.0),
    ('2023-03-13', 40.2),
    ('2023-03-14', 40.5),
    ('2023-03-15', 40.8),
    ('2023-03-16', 41.0),
    ('2023-03-17', 41.2),
    ('2023-03-18', 41.5),
    ('2023-03-19', 41.8),
    ('2023-03-20', 42.0),
    ('2023-03-21', 42.2),
    ('2023-03-22', 42.5),
    ('2023-03-23', 42.8),
    ('2023-03-24', 43.0),
    ('2023-03-25', 43.2),
    ('2023-03-26', 43.5),
    ('2023-03-27', 43.8),
    ('2023-03-28', 44.0),
    ('2023-03-29', 44.2),
    ('2023-03-30', 44.5),
    ('2023-03-31', 44.8),
]

MULTI_COLUMNS = ['timestamp', 'temperature', 'humidity', 'pressure', 'wind_speed']
MULTI = [
    ('2023-01-01 00:00:00', 22.1, 65.0, 1013.2, 2.5),
    ('2023-01-01 01:00:00', 21.8, 67.0, 1013.5, 2.3),
    ('2023-01-01 02:00:00', 21.5, 68.0, 1013.7, 2.1),
    ('2023-01-01 03:00:00', 21.2, 69.0, 1013.8, 1.9),
    ('2023-01-01 04:00:00', 21.0, 70.0, 1013.9, 1.8),
    ('2023-01-01 05:00:00', 20.9, 71.0, 1014.0, 1.7),
    ('2023-01-01 06:00:00', 20.8, 72.0, 1014.1, 1.6),
    ('2023-01-01 07:00:00', 21.0, 70.0, 1014.0, 1.8),
    ('2023-01-01 08:00:00', 21.5, 68.0, 1013.8, 2.2),
    ('2023-01-01 09:00:00', 22.0, 65.0, 1013.5, 2.5),
    ('2023-01-01 10:00:00', 22.5, 63.0, 1013.2, 2.8),
    ('2023-01-01 11:00:00', 23.0, 61.0, 1013.0, 3.0),
    ('2023-01-01 12:00:00', 23.5, 59.0, 1012.8, 3.2),
    ('2023-01-01 13:00:00', 24.0, 57.0, 1012.7, 3.5),
    ('2023-01-01 14:00:00', 24.5, 55.0, 1012.5, 3.7),
    ('2023-01-01 15:00:00', 25.0, 53.0, 1012.4, 3.9),
    ('2023-01-01 16:00:00', 25.2, 52.0, 1012.3, 4.0),
    ('2023-01-01 17:00:00', 25.0, 53.0, 1012.4, 4.1),
    ('2023-01-01 18:00:00', 24.5, 55.0, 1012.5, 3.8),
    ('2023-01-01 19:00:00', 24.0, 57.0, 1012.7, 3.5),
    ('2023-01-01 20:00:00', 23.5, 59.0, 1012.8, 3.2),
    ('2023-01-01 21:00:00', 23.0, 61.0, 1013.0, 2.9),
    ('2023-01-01 22:00:00', 22.5, 63.0, 1013.2, 2.6),
    ('2023-01-01 23:00:00', 22.2, 64.0, 1013.3, 2.4),
    ('2023-01-02 00:00:00', 22.0, 65.0, 1013.4, 2.2),
    ('2023-01-02 01:00:00', 21.8, 66.0, 1013.5, 2.1),
    ('2023-01-02 02:00:00', 21.6, 67.0, 1013.6, 1.9),
    ('2023-01-02 03:00:00', 21.4, 68.0, 1013.7, 1.8),
    ('2023-01-02 04:00:00', 21.3, None, 1013.8, 1.7),
    ('2023-01-02 05:00:00', 21.2, 70.0, 1013.9, 1.6),
    ('2023-01-02 06:00:00', 21.2, 71.0, 1014.0, 1.5),
    ('2023-01-02 07:00:00', 21.3, 70.0, 1013.9, 1.7),
    ('2023-01-02 08:00:00', 21.6, 68.0, 1013.7, 2.0),
    ('2023-01-02 09:00:00', 22.0, 66.0, 1013.5, 2.3),
    ('2023-01-02 10:00:00', 22.5, 64.0, 1013.2, 2.6),
    ('2023-01-02 11:00:00', 23.0, 62.0, 1013.0, 2.9),
    ('2023-01-02 12:00:00', 23.5, 60.0, 1012.8, 3.2),
    ('2023-01-02 13:00:00', 24.0, 58.0, 1012.6, 3.5),
    ('2023-01-02 14:00:00', 24.5, 56.0, 1012.5, 3.8),
    ('2023-01-02 15:00:00', 25.0, 54.0, 1012.3, 4.1),
    ('2023-01-02 16:00:00', 25.5, 52.0, 1012.2, 4.4),
    ('2023-01-02 17:00:00', 25.8, 51.0, 1012.1, 4.6),
    ('2023-01-02 18:00:00', 26.0, 50.0, 1012.0, 4.8),
    ('2023-01-02 19:00:00', 25.8, 51.0, 1012.1, 4.7),
    ('2023-01-02 20:00:00', 25.5, 52.0, 1012.2, 4.5),
    ('2023-01-02 21:00:00', 25.0, 54.0, 1012.4, 4.2),
    ('2023-01-02 22:00:00', 24.5, 56.0, 1012.6, 3.9),
    ('2023-01-02 23:00:00', 24.0, 58.0, 1012.8, 3.6),
    ('2023-01-03 00:00:00', 23.5, 60.0, 1013.0, 3.3),
    ('2023-01-03 01:00:00', 23.2, 61.0, 1013.1, 3.1),
    ('2023-01-03 02:00:00', 23.0, 62.0, 1013.2, 2.9),
    ('2023-01-03 03:00:00', 22.8, 63.0, 1013.3, 2.7),
    ('2023-01-03 04:00:00', 22.7, 64.0, 1013.4, 2.5),
    ('2023-01-03 05:00:00', 22.6, 65.0, 1013.5, 2.4),
    ('2023-01-03 06:00:00', 22.6, 66.0, 1013.6, 2.3),
    ('2023-01-03 07:00:00', 22.7, 65.0, 1013.5, 2.5),
    ('2023-01-03 08:00:00', 22.9, 63.0, 1013.3, 2.8),
    ('2023-01-03 09:00:00', 23.2, 61.0, 1013.1, 3.1),
    ('2023-01-03 10:00:00', 23.5, 59.0, 1012.9, 3.4),
    ('2023-01-03 11:00:00', 24.0, 57.0, 1012.7, 3.7),
    ('2023-01-03 12:00:00', 24.5, 55.0, 1012.5, 4.0),
    ('2023-01-03 13:00:00', 25.0, 53.0, 1012.3, 4.3),
    ('2023-01-03 14:00:00', 25.5, 51.0, 1012.1, None),
    ('2023-01-03 15:00:00', 26.0, 49.0, 1011.9, 4.9),
    ('2023-01-03 16:00:00', 26.5, 47.0, 1011.7, 5.2),
    ('2023-01-03 17:00:00', 26.8, 46.0, 1011.6, 5.4),
    ('2023-01-03 18:00:00', 27.0, 45.0, 1011.5, 5.6),
    ('2023-01-03 19:00:00', 26.8, 46.0, 1011.6, 5.5),
    ('2023-01-03 20:00:00', 26.5, 47.0, 1011.7, 5.3),
    ('2023-01-03 21:00:00', 26.0, 49.0, 1011.9, 5.0),
    ('2023-01-03 22:00:00', 25.5, 51.0, 1012.1, 4.7),
    ('2023-01-03 23:00:00', 25.0, 53.0, 1012.3, 4.4),
]

MULTI_CLEANED = [
    ('2023-01-01 00:00:00', 22.1, 65.0, 1013.2, 2.5),
    ('2023-01-01 01:00:00', 21.8, 67.0, 1013.5, 2.3),
    ('2023-01-01 02:00:00', 21.5, 68.0, 1013.7, 2.1),
    ('2023-01-01 03:00:00', 21.2, 69.0, 1013.8, 1.9),
    ('2023-01-01 04:00:00', 21.0, 70.0, 1013.9, 1.8),
    ('2023-01-01 05:00:00', 20.9, 71.0, 1014.0, 1.7),
    ('2023-01-01 06:00:00', 20.8, 72.0, 1014.1, 1.6),
    ('2023-01-01 07:00:00', 21.0, 70.0, 1014.0, 1.8),
    ('2023-01-01 08:00:00', 21.5, 68.0, 1013.8, 2.2),
    ('2023-01-01 09:00:00', 22.0, 65.0, 1013.5, 2.5),
    ('2023-01-01 10:00:00', 22.5, 63.0, 1013.2, 2.8),
    ('2023-01-01 11:00:00', 23.0, 61.0, 1013.0, 3.0),
    ('2023-01-01 12:00:00', 23.5, 59.0, 1012.8, 3.2),
    ('2023-01-01 13:00:00', 24.0, 57.0, 1012.7, 3.5),
    ('2023-01-01 14:00:00', 24.5, 55.0, 1012.5, 3.7),
    ('2023-01-01 15:00:00', 25.0, 53.0, 1012.4, 3.9),
    ('2023-01-01 16:00:00', 25.2, 52.0, 1012.3, 4.0),
    ('2023-01-01 17:00:00', 25.0, 53.0, 1012.4, 4.1),
    ('2023-01-01 18:00:00', 24.5, 55.0, 1012.5, 3.8),
    ('2023-01-01 19:00:00', 24.0, 57.0, 1012.7, 3.5),
    ('2023-01-01 20:00:00', 23.5, 59.0, 1012.8, 3.2),
    ('2023-01-01 21:00:00', 23.0, 61.0, 1013.0, 2.9),
    ('2023-01-01 22:00:00', 22.5, 63.0, 1013.2, 2.6),
    ('2023-01-01 23:00:00', 22.2, 64.0, 1013.3, 2.4),
    ('2023-01-02 00:00:00', 22.0, 65.0, 1013.4, 2.2),
    ('2023-01-02 01:00:00', 21.8, 66.0, 1013.5, 2.1),
    ('2023-01-02 02:00:00', 21.6, 67.0, 1013.6, 1.9),
    ('2023-01-02 03:00:00', 21.4, 68.0, 1013.7, 1.8),
    ('2023-01-02 04:00:00', 21.3, 69.0, 1013.8, 1.7),
    ('2023-01-02 05:00:00', 21.2, 70.0, 1013.9, 1.6),
    ('2023-01-02 06:00:00', 21.2, 71.0, 1014.0, 1.5),
    ('2023-01-02 07:00:00', 21.3, 70.0, 1013.9, 1.7),
    ('2023-01-02 08:00:00', 21.6, 68.0, 1013.7, 2.0),
    ('2023-01-02 09:00:00', 22.0, 66.0, 1013.5, 2.3),
    ('2023-01-02 10:00:00', 22.5, 64.0, 1013.2, 2.6),
    ('2023-01-02 11:00:00', 23.0, 62.0, 1013.0, 2.9),
    ('2023-01-02 12:00:00', 23.5, 60.0, 1012.8, 3.2),
    ('2023-01-02 13:00:00', 24.0, 58.0, 1012.6, 3.5),
    ('2023-01-02 14:00:00', 24.5, 56.0, 1012.5, 3.8),
    ('2023-01-02 15:00:00', 25.0, 54.0, 1012.3, 4.1),
    ('2023-01-02 16:00:00', 25.5, 52.0, 1012.2, 4.4),
    ('2023-01-02 17:00:00', 25.8, 51.0, 1012.1, 4.6),
    ('2023-01-02 18:00:00', 26.0, 50.0, 1012.0, 4.8),
    ('2023-01-02 19:00:00', 25.8, 51.0, 1012.1, 4.7),
    ('2023-01-02 20:00:00', 25.5, 52.0, 1012.2, 4.5),
    ('2023-01-02 21:00:00', 25.0, 54.0, 1012.4, 4.2),
    ('2023-01-02 22:00:00', 24.5, 56.0, 1012.6, 3.9),
    ('2023-01-02 23:00:00', 24.0, 58.0, 1012.8, 3.6),
    ('2023-01-03 00:00:00', 23.5, 60.0, 1013.0, 3.3),
    ('2023-01-03 01:00:00', 23.2, 61.0, 1013.1, 3.1),
    ('2023-01-03 02:00:00', 23.0, 62.0, 1013.2, 2.9),
    ('2023-01-03 03:00:00', 22.8, 63.0, 1013.3, 2.7),
    ('2023-01-03 04:00:00', 22.7, 64.0, 1013.4, 2.5),
    ('2023-01-03 05:00:00', 22.6, 65.0, 1013.5, 2.4),
    ('2023-01-03 06:00:00', 22.6, 66.0, 1013.6, 2.3),
    ('2023-01-03 07:00:00', 22.7, 65.0, 1013.5, 2.5),
    ('2023-01-03 08:00:00', 22.9, 63.0, 1013.3, 2.8),
    ('2023-01-03 09:00:00', 23.2, 61.0, 1013.1, 3.1),
    ('2023-01-03 10:00:00', 23.5, 59.0, 1012.9, 3.4),
    ('2023-01-03 11:00:00', 24.0, 57.0, 1012.7, 3.7),
    ('2023-01-03 12:00:00', 24.5, 55.0, 1012.5, 4.0),
    ('2023-01-03 13:00:00', 25.0, 53.0, 1012.3, 4.3),
    ('2023-01-03 14:00:00', 25.5, 51.0, 1012.1, 4.6),
    ('2023-01-03 15:00:00', 26.0, 49.0, 1011.9, 4.9),
    ('2023-01-03 16:00:00', 26.5, 47.0, 1011.7, 5.2),
    ('2023-01-03 17:00:00', 26.8, 46.0, 1011.6, 5.4),
    ('2023-01-03 18:00:00', 27.0, 45.0, 1011.5, 5.6),
    ('2023-01-03 19:00:00', 26.8, 46.0, 1011.6, 5.5),
    ('2023-01-03 20:00:00', 26.5, 47.0, 1011.7, 5.3),
    ('2023-01-03 21:00:00', 26.0, 49.0, 1011.9, 5.0),
    ('2023-01-03 22:00:00', 25.5, 51.0, 1012.1, 4.7),
    ('2023-01-03 23:00:00', 25.0, 53.0, 1012.3, 4.4),
]


# Whitened principal components of MULTI_CLEANED as written by the reference's demo run.
PROCESSED_COLUMNS = ['timestamp', 'PC1', 'PC2', 'PC3']
PROCESSED = [
    ('2023-01-01 00:00:00', -0.6618746415559695, -1.6232115278466428, 2.331242818254196),
    ('2023-01-01 01:00:00', -0.9266876377603782, -1.4717834745571856, 0.4136931590319821),
    ('2023-01-01 02:00:00', -1.1211361078123538, -1.1815499588567935, -0.2832627522310572),
    ('2023-01-01 03:00:00', -1.2795679766790842, -1.090695949779555, 0.003173278181611837),
    ('2023-01-01 04:00:00', -1.401204951191394, -1.3218906592832294, -0.3410291618686305),
    ('2023-01-01 05:00:00', -1.508364371698329, -1.138647403112803, -0.9309844393671284),
    ('2023-01-01 06:00:00', -1.615523792205263, -0.9554041469423642, -1.5209397168656364),
    ('2023-01-01 07:00:00', -1.4372215523765979, -1.1225111526603002, -1.3244211035432203),
    ('2023-01-01 08:00:00', -1.1348353686484312, -1.7186571364893437, -1.6515403269180555),
    ('2023-01-01 09:00:00', -0.7844019991169172, -1.4395109736521938, -0.3731801693201891),
    ('2023-01-01 10:00:00', -0.4683165545526727, -1.4985497798486855, 0.6679781819919753),
    ('2023-01-01 11:00:00', -0.21056505152267785, -0.621722395167225, 1.1106302246441906),
    ('2023-01-01 12:00:00', 0.0471864515073172, 0.2551049895142361, 1.5532822672964053),
    ('2023-01-01 13:00:00', 0.2912386937011531, 0.5948251965636041, 0.6276567352593887),
    ('2023-01-01 14:00:00', 0.5489901967311482, 1.4716525812450656, 1.0703087779116043),
    ('2023-01-01 15:00:00', 0.7707250985759387, 2.5478594725494585, 0.5295688788892315),
    ('2023-01-01 16:00:00', 0.8923620730882489, 2.7790541820531303, 0.8737713189394726),
    ('2023-01-01 17:00:00', 0.8153597792741109, 1.074886104038957, -0.24020238713781653),
    ('2023-01-01 18:00:00', 0.5713075370802342, 0.7351658969898165, 0.6854231448980812),
    ('2023-01-01 19:00:00', 0.2912386937011531, 0.5948251965636041, 0.6276567352593887),
    ('2023-01-01 20:00:00', 0.0471864515073172, 0.2551049895142361, 1.5532822672964053),
    ('2023-01-01 21:00:00', -0.23288239187176393, 0.11476428908802762, 1.4955158576577152),
    ('2023-01-01 22:00:00', -0.5129512352508449, -0.025576411338183825, 1.4377494480190238),
    ('2023-01-01 23:00:00', -0.6713831041175753, 0.06527759773905538, 1.7241854784316917),
    ('2023-01-02 00:00:00', -0.8153374189789712, 0.5705695724906303, 1.7648686713949753),
    ('2023-01-02 01:00:00', -0.9369743934912809, 0.3393748629869577, 1.4206662313447334),
    ('2023-01-02 02:00:00', -1.080928708352677, 0.844666837738538, 1.461349424308017),
    ('2023-01-02 03:00:00', -1.2025656828649873, 0.6134721282348478, 1.1171469842577861),
    ('2023-01-02 04:00:00', -1.3097251033718809, 0.796715384405062, 0.5271917067603951),
    ('2023-01-02 05:00:00', -1.4168845238788161, 0.9799586405754885, -0.06276357073810616),
    ('2023-01-02 06:00:00', -1.509566390380376, 1.577639862420028, -0.8984716856848721),
    ('2023-01-02 07:00:00', -1.3800896295243548, 0.657909921994351, -0.693402041199896),
    ('2023-01-02 08:00:00', -1.1289758941560644, -0.030625308927426174, -0.14412995666579886),
    ('2023-01-02 09:00:00', -0.8633846047823589, -0.3047225741753307, 0.1593892904211603),
    ('2023-01-02 10:00:00', -0.5472991602181143, -0.36376138037182454, 1.2005476417333234),
    ('2023-01-02 11:00:00', -0.2672303168390335, -0.22342067994561307, 1.2583140513720155),
    ('2023-01-02 12:00:00', 0.012838526540047667, -0.08307997951940498, 1.3160804610107057),
    ('2023-01-02 13:00:00', 0.2929073699190877, 0.05726072090703331, 1.3738468706482792),
    ('2023-01-02 14:00:00', 0.5369596121129645, 0.3969809279561757, 0.448221338612381),
    ('2023-01-02 15:00:00', 0.8170284554920455, 0.5373216283823867, 0.5059877482510738),
    ('2023-01-02 16:00:00', 1.061080697685882, 0.8770418354317485, -0.41963778378594746),
    ('2023-01-02 17:00:00', 1.2195125665526527, 0.7861878263542895, -0.706073814197493),
    ('2023-01-02 18:00:00', 1.3634668814140485, 0.28089585160271, -0.7467570071607765),
    ('2023-01-02 19:00:00', 1.2418299069017391, 0.049701142099033445, -1.0909594472110198),
    ('2023-01-02 20:00:00', 1.0833980380349677, 0.14055515117649944, -0.8045234167994707),
    ('2023-01-02 21:00:00', 0.8033291946559276, 0.00021445075006112094, -0.8622898264370431),
    ('2023-01-02 22:00:00', 0.5232603512768464, -0.14012624967614726, -0.9200562360757346),
    ('2023-01-02 23:00:00', 0.2431915078978064, -0.2804669501025862, -0.9778226457133091),
    ('2023-01-03 00:00:00', -0.03687733548127472, -0.42080765052879465, -1.0355890553519993),
    ('2023-01-03 01:00:00', -0.19530920434804588, -0.32995364145133305, -0.7491530249404501),
    ('2023-01-03 02:00:00', -0.33926351920944176, 0.17533833330024637, -0.708469831977166),
    ('2023-01-03 03:00:00', -0.4832178340707967, 0.6806303080515959, -0.6677866390127657),
    ('2023-01-03 04:00:00', -0.612694594926818, 1.600360248477276, -0.8728562834977389),
    ('2023-01-03 05:00:00', -0.7198540154337526, 1.783603504647717, -1.4628115609962473),
    ('2023-01-03 06:00:00', -0.8125358819353123, 2.381284726492258, -2.2985196759430133),
    ('2023-01-03 07:00:00', -0.6830591210792916, 1.461554786066564, -2.0934500314580307),
    ('2023-01-03 08:00:00', -0.446422939716336, 0.3585815894704469, -1.298425109474547),
    ('2023-01-03 09:00:00', -0.19530920434804588, -0.32995364145133305, -0.7491530249404501),
    ('2023-01-03 10:00:00', 0.05580453102028513, -1.0184888723733365, -0.19988094040523374),
    ('2023-01-03 11:00:00', 0.33587337439932535, -0.8781481719469009, -0.14211453076766126),
    ('2023-01-03 12:00:00', 0.6159422177784066, -0.737807471520689, -0.08434812112896918),
    ('2023-01-03 13:00:00', 0.8960110611574872, -0.5974667710944781, -0.02658171149027659),
    ('2023-01-03 14:00:00', 1.1760799045365273, -0.45712607066803884, 0.031184698147297196),
    ('2023-01-03 15:00:00', 1.4561487479156086, -0.3167853702418349, 0.0889511077859863),
    ('2023-01-03 16:00:00', 1.7362175912946487, -0.17644466981539764, 0.1467175174235624),
    ('2023-01-03 17:00:00', 1.8946494601614199, -0.26729867889286096, -0.1397185129879909),
    ('2023-01-03 18:00:00', 2.038603775022816, -0.7725906536444338, -0.1804017059512724),
    ('2023-01-03 19:00:00', 1.9169668005105056, -1.0037853631481086, -0.5246041460015134),
    ('2023-01-03 20:00:00', 1.7585349316437349, -0.9129313540706465, -0.23816811558996065),
    ('2023-01-03 21:00:00', 1.4784660882646945, -1.053272054497084, -0.2959345252275367),
    ('2023-01-03 22:00:00', 1.1983972448856137, -1.1936127549232955, -0.35370093486622983),
    ('2023-01-03 23:00:00', 0.9183284015065732, -1.3339534553497332, -0.41146734450380307),
]
