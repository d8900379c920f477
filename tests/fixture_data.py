"""The small inputs whose expected results the process tests check."""

CATEGORY = """\
1,2,Football
2,2,Soccer
3,2,Baseball & Softball
4,2,Basketball
5,2,Lacrosse
6,2,Tennis & Racquet
7,2,Hockey
8,2,More Sports
9,3,Cardio Equipment
10,3,Strength Training
11,3,Fitness Accessories
12,3,Boxing & MMA
13,3,Electronics
14,3,Yoga & Pilates
15,3,Training by Sport
16,3,As Seen on  TV!
17,4,Cleats
18,4,Men's Footwear
19,4,Women's Footwear
20,4,Kids' Footwear
21,4,Featured Shops
22,4,Accessories
23,5,Men's Apparel
24,5,Women's Apparel
25,5,Boys' Apparel
26,5,Girls' Apparel
27,5,Accessories
28,5,Top Brands
29,5,Shop By Sport
30,6,Men's Golf Clubs
31,6,Women's Golf Clubs
32,6,Golf Apparel
33,6,Golf Shoes
34,6,Golf Bags & Carts
35,6,Golf Gloves
36,6,Golf Balls
37,6,Electronics
38,6,Kids' Golf Clubs
39,6,Team Shop
40,6,Accessories
41,6,Trade-In
42,7,Bike & Skate Shop
43,7,Camping & Hiking
44,7,Hunting & Shooting
45,7,Fishing
46,7,Indoor/Outdoor Games
47,7,Boating
48,7,Water Sports
49,8,MLB
50,8,NFL
51,8,NHL
52,8,NBA
53,8,NCAA
54,8,MLS
55,8,International Soccer
56,8,World Cup Shop
57,8,MLB Players
58,8,NFL Players
"""

DEPARTMENT_NAMES = """\
2,Fitness
3,Footwear
4,Apparel
5,Golf
6,Outdoors
7,Fan Shop
"""

CATEGORY_QUOTE = """\
c0,c1,c2
1,2,Football
2,2,Soccer
3,2,?Baseball, & Softball?
4,2,Basketball
5,2,?Lacrosse,123?
"""

CATEGORY_DELIMITER = """\
1¿2¿Football
2¿2¿Soccer
3¿2¿Baseball5 & Softball
4¿2¿Basketball
"""

CATEGORY_VALIDATION = """\
1,2,Football12sasdsdewdffffs
2,2,Soccer
3,2,Baseball & Softball
4,2,Basketball
-1,2,aaaaaaa
,2,mmmmmmmmmmmmmmmmmmmmmm
10,1,mmmmmmmmmmmmmmmmmmm
6,2,Foot
"""

FIXED_WIDTH = """\
038727664 0521829914551 6034
309863616 9230548141754 2250
413357870 4683599601206 2154
714076809 2325024615368 4159
803240216 6352795449571 1306
614315123 9247500379568 0824
324159160 0290632773564 4185
815681323 0966724054037 2149
902679634 4705301361845 1228
778136531 2025984245691 0036
778136531 2025984245691 0038errorrecord
"""

FIXED_WIDTH_STATUS = (
    "309863616Assigned13  2010-03-05 14:23:00Sridar\n"
    "714076809Open    13  2010-03-05 19:50:00      \n"
    "815681323Resolved13  2010-03-05 19:50:00Niku  \n"
)

DEPARTMENTS = [
    ("10", "ACCOUNTING", "NEW YORK"),
    ("20", "RESEARCH", "BOSTON"),
    ("30", "SALES", "CHICAGO"),
    ("40", "OPERATIONS", "BOSTON"),
    ("50", "ADMIN", "CHICAGO"),
]

EMPLOYEES = [
    ("7839", "KING", "PRESIDENT", "null", "17-11-1981", "5000", "null", "10"),
    ("7698", "BLAKE", "MANAGER", "7839", "1-5-1981", "2850", "null", "30"),
    ("7782", "CLARK", "MANAGER", "7839", "9-6-1981", "2450", "null", "10"),
    ("7566", "JONES", "MANAGER", "7839", "2-4-1981", "2975", "null", "20"),
    ("7788", "SCOTT", "ANALYST", "7566", "13-7-1987", "3000", "null", "20"),
    ("7902", "FORD", "ANALYST", "7566", "3-12-1981", "3000", "null", "20"),
    ("7369", "SMITH", "CLERK", "7902", "17-12-1980", "800", "null", "20"),
    ("7499", "ALLEN", "SALESMAN", "7698", "20-2-1981", "1600", "300", "30"),
    ("7521", "WARD", "SALESMAN", "7698", "22-2-1981", "1250", "500", "30"),
    ("7654", "MARTIN", "SALESMAN", "7698", "28-9-1981", "1250", "1400", "30"),
    ("7844", "TURNER", "SALESMAN", "7698", "8-9-1981", "1500", "0", "30"),
    ("7876", "ADAMS", "CLERK", "7788", "13-7-1987", "1100", "null", "20"),
    ("7900", "JAMES", "CLERK", "7698", "3-12-1981", "950", "null", "30"),
    ("7934", "MILLER", "CLERK", "7782", "23-1-1982", "1300", "null", "10"),
]
