"""Published results the operators must reproduce."""

# Weekly series (group, week, mean lexicon score, positive rows, all rows).
WEEKLY = """
Conservative 1 0.05311480991992493 388 12863
Conservative 2 -0.1755871507875689 888 44314
Conservative 3 0.0034092155774479234 1220 43242
Conservative 4 0.016056148501418347 920 48646
Conservative 5 -0.051914370300635275 2012 80729
Conservative 6 -0.03841448975167904 3365 83038
Conservative 7 -0.018524127383133537 1739 66037
Conservative 8 -0.019170238642537866 1780 47854
Conservative 9 -0.09300708747710065 1496 61136
Conservative 10 -0.0749046510800734 2579 84346
Conservative 11 -0.039046064703669114 3005 77059
Conservative 12 0.05714579694019503 3178 71900
Conservative 13 0.05149261839585501 3366 85117
Conservative 14 0.014030693780703625 1684 59846
Conservative 15 0.04916018642533942 2382 55250
Conservative 16 -0.01211497875640112 2253 61901
Conservative 17 0.0683564417513576 2875 73109
Conservative 18 0.07537072672567144 2137 45533
Liberal 1 0.061061260458099044 454 14582
Liberal 2 0.04378877830405544 1644 50037
Liberal 3 0.09082883731857536 1747 38308
Liberal 4 0.09777920905028975 698 21038
Liberal 5 -0.009452409519228244 1583 35339
Liberal 6 0.008581882063332403 1733 44685
Liberal 7 0.09352325556099444 1521 36774
Liberal 8 0.017176240870075132 2077 37514
Liberal 9 0.025333984710625142 1914 45391
Liberal 10 0.040499261528055386 2942 53218
Liberal 11 0.0007619579822637099 3407 63259
Liberal 12 0.12079766239220895 4043 76189
Liberal 13 0.07872472944693577 3531 66900
Liberal 14 0.12158328705173004 2938 50416
Liberal 15 0.0572927599432564 2949 57099
Liberal 16 0.023122503379014045 3256 58449
Liberal 17 0.07124804338819639 3101 53102
Liberal 18 0.0833901144641002 3177 50933
NDP 1 0.13984826475849718 153 2795
NDP 2 0.0721472069236825 403 7626
NDP 3 0.07013502695637966 231 6121
NDP 4 0.2058605913106172 211 5547
NDP 5 0.14179853274484097 414 8383
NDP 6 0.07495641221374033 366 7860
NDP 7 0.11991849315068481 455 11096
NDP 8 0.06555052797669618 435 8239
NDP 9 0.04476279269234051 510 11659
NDP 10 0.18412266051196002 354 7149
NDP 11 0.10216915062287656 512 8830
NDP 12 0.07786512550490486 822 13864
NDP 13 0.11119762528912894 665 12970
NDP 14 0.12821266918668459 431 8201
NDP 15 0.09243437587657784 416 7130
NDP 16 -0.005784419926446145 613 11964
NDP 17 0.05480113910368338 584 12027
NDP 18 0.093592930684455 838 13792
"""

# Mean weekly polls (week, lpc, cpc, ndp).
POLLS = """
1 20.1 44.2 19.3
2 21.5 44.5 18.1
3 21.9 44.8 17.6
4 22.5 44.4 17.5
5 23.4 43.4 17.3
6 25.5 42.4 16.5
7 26.5 42.2 15.9
8 27.4 41.8 15.4
9 30.8 40.25 14.4
10 31.9 39.8 14.0
11 33.4 38.9 13.5
12 37.42857143 37.32142857 11.60714286
13 40.71428571 37.47142857 9.41428571
14 43.67142857 37.42857143 8.37142857
15 44.02857143 37.44285714 8.48571429
16 43.54285714 37.97142857 8.34285714
17 42.6 38.61666667 8.46666667
"""

# Published weekly correlations (group, lag, lexicon Pearson, Spearman,
# class-share Pearson, Spearman).
CORRELATIONS = """
Liberal 0 0.212 0.1201 0.8055 0.7843
Conservative 0 -0.3929 -0.3971 -0.6757 -0.6324
NDP 0 0.3482 0.2745 -0.4095 -0.2869
Liberal 1 0.2376 0.098 0.8075 0.7672
Conservative 1 -0.5691 -0.4975 -0.669 -0.6127
NDP 1 0.2744 0.1618 -0.5526 -0.5101
"""

# Weekly regressions (group, measure, slope, intercept, t, p, r2).
REGRESSIONS = """
Liberal vader_avg 45.419704 29.062987 0.8407 0.4137 0.045002
Liberal trans_pos_ratio 765.065124 -4.613032 5.2746 9.35e-05 0.649712
Conservative vader_avg -17.522842 40.542590 -1.6549 0.1187 0.154393
Conservative trans_pos_ratio -239.396104 48.519159 -3.5516 0.0029 0.456792
NDP vader_avg 26.147010 11.191836 1.4384 0.1709 0.121208
NDP trans_pos_ratio -241.803534 25.803628 -1.7313 0.1039 0.166551
"""


def rows(text):
    return [line.split() for line in text.strip().splitlines()]
